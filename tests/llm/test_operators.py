"""Each operator against a plain version, and on nulls, empty texts, repeated rows, empty tables and further columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folio.llm import base, decontaminate, jaccard, packing, perplexity, pii, quality, secrets, suffix, tokens, toxicity
from folio.llm.base import TokenIds, words_of
from folio.llm.components import components
from folio.llm.queries import vocabulary
from folio.session import BATCH_BYTES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, _row long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, g, "s", 0, "k", 7, 7) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    syllables = "ba ce di fo gu ka le mi no pu".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    base = [" ".join(word() for _ in range(n)) for n in (3, 12, 60, 200, 700)]
    out = [(i, rng.choice(base), "en") for i in range(40)]
    for i in range(40, 160):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = word()
        out.append((i, " ".join(words) + rng.choice(["", ".\n", "\n" + word()]), rng.choice(["en", "fr", None])))
    out += [(200, None, "en"), (201, "", None), (202, " \n\t", "fr"), (203, "a b", "en"), (204, "A  b", "en"), (205, "x", "en")]
    out += [(206, "ab" * 900, "en"), (207, "z" * 401, "en"), (208, "y" * 400, "en"), (210, "é😀 " * 3000, "en")]
    out += [(209, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" mail a.b@c.example +1 (443) 555-5793', "en")] * 2
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_token_ids_are_the_library_s():
    rng = random.Random(1)
    letters = "aAzZéÉßÿµªİσΣ中の한é́.,;:!?#'\"-_0129 \n\t\r\x0b😀ﬁ<|>sStTreveLl"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += ["<|endoftext|> it's We'LL", "", "word. word, word"]
    memory = TokenIds(vocabulary(), room=500)
    want = memory.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in memory.encode(texts)] == [w.ids for w in want]


def test_even_texts_are_told_by_bytes():
    texts = [a + b for a in map(chr, range(128)) for b in map(chr, range(128))] + ["é.", "é..", "—", "a. b, c"]
    assert [base._even(x) for x in texts] == [not base._UNEVEN.search(x) for x in texts]


def test_elias_fano_round_trip():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 0), (5, 3), (300, 10), (1000, 10**12)):
        values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
        ef, rest = tokens.EliasFano.unpack(memoryview(tokens.EliasFano.of(values).pack()))
        assert ef.values().tolist() == values.tolist() and not len(rest)
        assert [ef.select(i) for i in range(n)] == values.tolist()


def test_token_files(spark, docs, rows, none):
    encode = TokenIds(vocabulary()).tokenizer.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)
    start, want = 0, []
    for (i, _, _), ids in sorted(zip(rows, (e.ids + [1] for e in encode)), key=lambda x: x[0][0]):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got(tokens.token_files(docs, vocabulary()), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert tokens.token_files(none, vocabulary()).count() == 0


def test_packing(docs, rows, none):
    out = packing.pack(docs, vocabulary(), limit=256, end_id=0).toPandas()
    encode = TokenIds(vocabulary()).tokenizer.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)
    want = []
    for (i, _, _), e in zip(rows, encode):
        ids = e.ids + [0]
        want += [(i, k, a, len(ids[a : a + 256]), zlib.crc32(np.array(ids[a : a + 256], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out[names].values.tolist())) == sorted(want)
    sizes = []
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == (part.length.cumsum() - part.length).tolist()
        sizes.append(part.length.sum())
    assert max(sizes) <= 256 and len(sizes) <= -(-sum(sizes) // 256) * 1.03 + 1
    assert packing.pack(none, vocabulary()).count() == 0


ASSIGN = re.compile(secrets._KEY + r"([A-Za-z0-9+/_.=-]+)")


def test_secrets(spark, docs, none):
    rng = random.Random(8)
    bits = ["token", "Secret", "api_key", "=", ":", " ", '"', "'", "AKIA", "ABCD1234EFGH5678", "abcdef0123456789", "é", "\n", "x", "-", "passwdpasswd"]
    more = [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30))), "en") for i in range(1500)]
    both = docs.union(frame(spark, more))
    texts = [(r.doc_id, r.text or "") for r in both.select("doc_id", "text").collect()]
    want = []
    for i, t in texts:
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        want.append((i, *(sum(k == j for _, k, _ in spans) for j in range(3)), hashlib.sha256(said.encode()).hexdigest()))
    report = secrets.secret_report(both)
    assert got(report, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)
    assert report.filter("doc_id = 209").first().spans.startswith("assign:0:49,hex:9:49")
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.filter("text is null").count() == 1
    assert secrets.secret_report(clean).agg({"n_assign": "sum", "n_hex": "sum"}).first()[0] == 0
    assert secrets.secret_report(none).count() == 0


def test_pii(spark, docs, none):
    rng = random.Random(9)
    bits = ["a", ".", "@", "example", "com", "-", "+", "1", "23", "4111111111111111", "(017) 555-7713", "+1 ", "10.0.0.1", "255", " ", "é", "\n", "%"]
    both = docs.union(frame(spark, [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25))), "en") for i in range(1500)]))
    rules = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")

    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return (True, kind == 1 and all(int(x) <= 255 for x in s.split(".")), 12 <= len(digits) <= 19 and pii._luhn(digits), 9 <= len(digits) <= 15)[kind]

    want = []
    for i, t in [(r.doc_id, r.text or "") for r in both.select("doc_id", "text").collect()]:
        spans = sorted((m.start(), k, m.end()) for k, rule in enumerate(rules) for m in re.finditer(rule, t) if good(k, m[0]))
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i, *(sum(k == j for _, k, _ in spans) for j in range(4)), hashlib.sha256(said.encode()).hexdigest()))
    assert got(pii.pii_report(both), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)
    assert pii.pii_report(none).count() == 0


def test_field_learns_a_pattern():
    lines = [[f"call +1 ({k:03d}) 555-{1000 + k} now", f"room {k} of {k + 1}"] for k in range(100)]
    field = pii.train(lines)
    maker = pii.FeatureMaker()
    words = ["call", "+1", "(999)", "555-9999", "now"]
    assert field.decode([maker.of(words)])[0] == [0, 4, 4, 4, 0]


def test_quality_rules(docs, none):
    def base(t):
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        count = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        covered = {j for k in range(len(words) - 4) if count[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)

    out = perplexity.quality_rules(docs)
    want = [(r.doc_id, *base(r.text or "")) for r in docs.collect()]
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted(want, key=repr)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert perplexity.quality_rules(none).count() == 0


def kneser_ney(words):
    """A plain model of counted words: the probability of a gram's last byte after the others, and the counts of each order."""
    top = Counter()
    for word, n in words.items():
        body = bytes([perplexity.START]) * (perplexity.ORDER - 1) + word + bytes([perplexity.END])
        for k in range(len(body) - perplexity.ORDER + 1):
            top[body[k : k + perplexity.ORDER]] += n
    orders = {perplexity.ORDER: top}
    for k in range(perplexity.ORDER - 1, 0, -1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    cuts, total, free = {}, defaultdict(int), defaultdict(float)
    for k, grams in orders.items():
        n = Counter(min(x, 5) for x in grams.values())
        y = n[1] / max(n[1] + 2 * n[2], 1)
        cuts[k] = [min(max(i - (i + 1) * y * n[i + 1] / max(n[i], 1), 0.1), i - 0.1) for i in (1, 2, 3)]
        for g, x in grams.items():
            total[g[:-1]] += x
            free[g[:-1]] += cuts[k][min(x, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / 256
        x, h = orders[len(gram)][gram], gram[:-1]
        own = x - cuts[len(gram)][min(x, 3) - 1] if x else 0
        return (own + free[h] * p(gram[1:])) / total[h] if h in total else p(gram[1:])

    return p, orders


def test_model_is_kneser_ney_and_adds_up(docs):
    words = defaultdict(Counter)
    for r in docs.collect():
        words[r.lang or ""].update((r.text or "").encode().translate(perplexity._FOLD).split())
    model = {(r.lang, r.k, r.gram): (r.n, r.logp) for r in perplexity.train(docs).collect()}
    assert {lang for lang, _, _ in model} == {lang for lang in words if words[lang]}
    for lang, counts in words.items():
        p, orders = kneser_ney(counts)
        for k, grams in orders.items():
            assert {int.from_bytes(g, "big") for g in grams} == {g for own, size, g in model if (own, size) == (lang, k)}
            for gram, n in grams.items():
                assert model[lang, k, int.from_bytes(gram, "big")] == (n, pytest.approx(np.log(p(gram)), abs=1e-9))
            for context in {g[:-1] for g in grams}:
                assert sum(p(context + bytes([x])) for x in range(256)) == pytest.approx(1, abs=1e-9)


def test_every_counted_gram_is_scored(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "HELD", 100_000, raising=False)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(50)) for _ in range(1200)]
    docs = frame(spark, [(k, t, "en") for k, t in enumerate(texts)] + [(5000, f"{texts[0]} {texts[0][:8]}", "en"), (5001, "xq zj", "la")])
    logp = {(r.lang, r.gram): r.logp for r in perplexity.train(docs).filter(f"k = {perplexity.ORDER}").collect()}
    for r in perplexity.quality_rules(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        words = [w.encode() for w in r.text.split()]
        packed, _ = perplexity._grams(words)
        assert r.cost == pytest.approx(-sum(logp[r.lang, g] for g in packed.tolist()) / len(packed), abs=1e-4)


def test_words_with_digits_are_scored(spark):
    rng = random.Random(12)
    syllables = "ba ce di fo gu ka le mi no pu ra se ti vo".split()
    known = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(120)]
    prose = lambda n: [rng.choice(known) for _ in range(n)]
    rows = [(k, " ".join(prose(80) + [str(rng.randrange(10 ** rng.randint(1, 4))) for _ in range(k % 4)]), "en") for k in range(400)]
    key = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    kinds = ["0123456789abcdef", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"]
    rows += [(1000 + k, " ".join("7" + key(letters, 31) for _ in range(20)), "en") for k, letters in enumerate(kinds)]
    rows += [(1010, " ".join("-".join(key(kinds[0], n) for n in (8, 4, 4, 4, 12)) + "0" for _ in range(20)), "en")]
    out = {r.doc_id: r for r in perplexity.quality_rules(frame(spark, rows)).collect()}
    assert all(r.cost is not None and not r.base_failed for r in out.values())
    assert all(r.kept for k, r in out.items() if k < 1000)
    assert not out[1000].kept and not out[1010].kept


def test_joins_of_repeats_are_the_same_at_every_size(docs):
    plan = suffix.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_repeats(docs, none):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    count = Counter(t[q : q + 400] for _, t in texts for q in range(len(t) - 399))
    want = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for q in range(len(t) - 399):
            if count[t[q : q + 400]] > 1:
                gone[q : q + 400] = True
        kept = bytes(c for c, x in zip(t, gone) if not x)
        want.append((i, len(t), int(gone.sum()), len(re.findall(b"\x01+", gone.tobytes())), hashlib.sha256(kept).hexdigest()))
    for block in (1000, 2):
        out = suffix.remove_repeats(docs, block=block)
        assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert suffix.remove_repeats(none).count() == 0


def brute_classes(rows, size, percent):
    sets = []
    for i, t in rows:
        w = [x.decode() for x in words_of(t or "")]
        sets.append((i, frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = defaultdict(lambda: 10**9)
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least[find(k)], i)
    return [(i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize(("size", "percent", "long_"), [(3, 90, 64), (5, 80, 64), (3, 90, 3)])
def test_jaccard(monkeypatch, docs, none, size, percent, long_):
    monkeypatch.setattr(jaccard, "LONG", long_)
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()], size, percent)
    assert got(jaccard.jaccard_classes(docs, size, percent), "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert jaccard.jaccard_classes(none).count() == 0


def test_near_copies_that_do_not_link_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(150)] = f"u{rng.randrange(10**9)}"
        rows.append((i, " ".join(words), "en"))
    met, holding = [], jaccard.holding
    monkeypatch.setattr(jaccard, "holding", lambda pairs, *more: met.append(pairs.count()) or holding(pairs, *more))
    out = got(jaccard.jaccard_classes(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert out == sorted(brute_classes([r[:2] for r in rows], 3, 90), key=repr)
    assert sum(met) < len(rows) * (len(rows) - 1) / 2 / 5


def test_near_copies_are_compared_with_one_class_of_their_group(spark, monkeypatch):
    """The rows of differences, and of joins by them, grow as the group does."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(150)] = f"u{rng.randrange(10**9)}"
        rows.append((i, " ".join(words), "en"))
    differ, mixed, made, joined = jaccard.differences, jaccard._mixed, [], []
    monkeypatch.setattr(jaccard, "differences", lambda pairs, *more: made.append(pairs.count()) or differ(pairs, *more))

    def noted(lists, roots, on):
        out = mixed(lists, roots, on)
        joined.extend([out.count()] if "lead" in on else [])
        return out

    monkeypatch.setattr(jaccard, "_mixed", noted)
    out = got(jaccard.jaccard_classes(frame(spark, rows), 5, 80), "doc_id", "n_shingles", "component_id")
    assert out == sorted(brute_classes([r[:2] for r in rows], 5, 80), key=repr)
    assert len(made) == 1 and 0 < made[0] < 1.5 * len(rows), made
    assert len(joined) == 1 and 0 < joined[0] < 40 * len(rows), joined


def test_classes_without_an_id_are_linked(spark):
    words = [f"w{k}" for k in range(120)]
    text = lambda first, last: " ".join([f"x{k}" for k in range(first)] + words[first : 120 - last] + [f"y{k}" for k in range(last)])
    rows = [(7, text(0, 0), "en"), (None, text(4, 0), "en"), (3, text(8, 0), "en"), (None, text(60, 0), "en"), (None, "a b", "en")]
    out = jaccard.jaccard_classes(frame(spark, rows))
    assert got(out, "doc_id", "component_id") == sorted([(7, 3), (None, 3), (3, 3), (None, None), (None, None)], key=repr)


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (103, 100), (7, 7)], "a long, b long")
    want = [(k, 0) for k in range(61)] + [(k, 100) for k in range(100, 104)]
    assert got(components(links), "node", "root") == sorted(want, key=repr)


def test_decontamination(spark, none):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.randint(10, 150)))) for k in range(20)] + [(90, None), (91, ""), (92, "a b c")]
    plain = [" ".join(word() for _ in range(rng.randint(0, 300))) for _ in range(120)]
    rows, want = [], set()
    for i, t in enumerate(plain):
        if i % 3 == 0:
            k = i % 20
            words = items[k][1].split()
            words[len(words) // 3] = word()
            t, want = f"{t} {' '.join(words).upper()}, {word()}", want | {(i, k)}
        rows.append((i, t, "en"))
    docs = frame(spark, [*rows, (500, None, None), (501, "", "en")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == want
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {i for i, _ in want}
    assert decontaminate.leaks(none, bench).count() == 0
    assert decontaminate.clean(docs, bench.filter("item_id < 0")).count() == docs.count()


def test_items_with_few_rare_words_are_found(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    stop, rare = [word() for _ in range(40)], [word() for _ in range(60)]
    few = [" ".join(rng.sample(stop, 14) + [word()]) for _ in range(6)]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(few)] + [(50, " ".join(rare))], "item_id long, text string")
    rows = [(k, " ".join(rng.sample(stop, 3) + [word() for _ in range(60)] + rng.sample(stop, 4) + [few[k % 6].split()[-1]] * (k < 60)), "en") for k in range(500)]
    want = set()
    for k, t in enumerate(few):
        rows.append((1000 + k, " ".join([*rng.sample(rare, 60), t, *rng.sample(rare, 60)]), "en"))
        want.add((1000 + k, k))
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), bench).collect()} == want


def test_items_are_found_by_their_cosine(spark, monkeypatch):
    """Items that are not thin are found by the latent space alone: not where its directions belong to other items."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    stop = [word() for _ in range(30)]
    mixed = lambda n: [rng.choice(stop) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [mixed(40) for _ in range(30)]
    changed = lambda item, share: [word() if rng.random() < share else w for w in item]
    rows, want = [], {0.0: set(), 0.2: set(), 0.3: set()}
    for k in range(600):
        t = mixed(150)
        if k % 2:
            share = (0.0, 0.2, 0.3)[k // 2 % 3]
            at, item = rng.randrange(150), k % 30
            t[at:at] = changed(items[item], share)
            want[share].add((k, item))
        rows.append((k, " ".join(t), "en"))
    docs, bench = frame(spark, rows), spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    block = next(iter(decontaminate.blocks(bench)))
    idf, space = decontaminate._finder(decontaminate.numbered(docs, block), block)
    numbers = [decontaminate.word_ids(block.words, t) for _, t, _ in rows]

    def find(thin=decontaminate.THIN, turned=False):
        monkeypatch.setattr(decontaminate, "THIN", thin)
        finder = decontaminate.LeakFinder(block, idf, space)
        if turned:  # each item has the direction of another
            finder.queries = np.roll(finder.queries, 1, axis=1)
        state = {"finder": finder, "all": np.ones(len(block.words), bool)}
        return {(k, block.item_ids[item]) for k, item, *_ in decontaminate._search(block, idf, space, numbers, state)}

    found, everything = find(), find(thin=1000)  # by their words, whatever the cosine
    assert found <= everything <= set().union(*want.values())
    for pairs in want.values():
        assert len(found & pairs) >= 0.94 * len(everything & pairs)
    assert want[0.0] <= found
    assert len(find(turned=True)) < len(found) / 2
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == found


def test_windows_are_summed_by_stride_and_thin_items_found_by_words_alone():
    """The windows of many texts at once, as one window after the other has them; no thin or weak item is compared by cosine."""
    rng = np.random.default_rng(5)
    block = decontaminate.Block.of([(k, " ".join(f"w{x}" for x in rng.integers(0, 60, n))) for k, n in enumerate([3, 5, 6, 9, 20, 40, 150] * 3)])
    idf = np.where(rng.random(len(block.words)) < 0.3, 0.0, 1.0)
    space = (rng.standard_normal((len(idf), 12)) * idf[:, None]).astype(np.float32)
    finder = decontaminate.LeakFinder(block, idf, space)
    assert len(finder.thin) and len(finder.by_cosine) and len(finder.thin) + len(finder.weak) < len(block.items)
    numbers = [np.where(rng.random(n) < 0.6, rng.integers(0, len(idf), n), -1).astype(np.int32) for n in (1, 2, 31, 32, 33, 63, 64, 65, 96, 97, 128, 300, 1000)]
    held = list(decontaminate._tokens(numbers, finder.active))
    near, by_words = set(), set()
    for k, (_, ids, places, terms) in enumerate(held):
        for start in range(0, max(1, len(ids) - 32), 32):
            inside = space[terms[(places >= start) & (places < start + 64)]].sum(0)
            for q, item in enumerate(finder.owner.tolist()):
                size, need = finder.sizes[item], finder.need[item]
                if need > decontaminate.THIN and inside.any() and inside @ finder.queries[:, q] >= decontaminate.COSINE * np.linalg.norm(inside):
                    near.add((k, start, item))
                around = (places >= start - size) & (places < start + 64 + size)
                if 0 < need <= decontaminate.THIN and np.isin(terms[around], block.items[item]).sum() >= need:
                    by_words.add((k, start, item))
    assert set(zip(*(x.tolist() for x in finder.candidates(held)[:3]))) == near
    assert set(zip(*(x.tolist() for x in finder.by_words(held)))) == by_words
    assert near and by_words


def test_every_place_of_a_document_is_judged(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    asked, answer = [word() for _ in range(30)], [word() for _ in range(10)]
    bench = spark.createDataFrame([(1, f"{' '.join(asked)}? {' '.join(answer)}.")], "item_id long, text string")
    gap = [word() for _ in range(400)]
    text = " ".join([*gap[:200], *asked[:29], *gap[200:], *asked[:19], *answer[:7]])
    rows = [(k, " ".join(word() for _ in range(80)), "en") for k in range(50)] + [(100, text, "en"), (101, " ".join([*gap[:200], *asked[:29], *gap[200:]]), "en")]
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), bench).collect()} == {(100, 1)}


def held_out(df, labels, column):
    data = df.filter("held_out").join(labels, "doc_id").select("predicted", column).toPandas()
    return float((data.predicted == data[column]).mean())


def test_classifiers(spark, docs, none):
    base = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    scores = quality.quality_scores(documents, labels)
    assert held_out(scores, labels, "quality") > 0.95 and scores.count() == documents.count()
    bad = toxicity.toxicity_scores(documents, labels)
    assert held_out(bad, labels, "toxic") > 0.9
    for out in (scores, bad):
        assert out.filter("score < 0 or score > 1 or score is null").count() == 0
        wrong = [r for r in out.collect() if r.predicted != int(r.score >= 0.3)]
        assert not wrong
    unlabelled = labels.filter("doc_id < 0")
    assert quality.quality_scores(docs, unlabelled).count() == docs.count()
    assert toxicity.toxicity_scores(docs, unlabelled).count() == docs.count()
    assert quality.quality_scores(none, labels).count() == 0 and toxicity.toxicity_scores(none, labels).count() == 0


def test_fold():
    table = toxicity._Fold()
    assert toxicity.fold("1d10t, ÏDIOT! trаsh sc​um $tupid 10 $$$", table) == " idiot idiot trash scum stupid "


def test_stages_send_long_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    @corpus_pipeline.stage
    def measured(spark, docs, sf_dir):
        return docs.select("text").mapInArrow(sizes, "rows long, bytes long")

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        found = measured(spark, spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text")), "").collect()
    finally:
        spark.conf.set(key, before)
    assert sum(r.rows for r in found) == 60
    assert max(r.bytes for r in found) < BATCH_BYTES + 300_000


def test_pipeline(spark, sf_dir, docs):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, sf_dir)
        assert after.columns == rows.columns and after.count() <= rows.count(), name
        rows = after
    odd = docs.withColumn("_row", F.xxhash64("doc_id")).withColumn("_docs", F.lit("x")).withColumn("cost", F.lit(1.5))
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates):
        assert stage(spark, odd, sf_dir).exceptAll(odd).count() == 0  # whole rows, values of any further column included
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    want = {c for _, _, c in brute_classes([(k, r.text) for k, r in enumerate(docs.collect())], 5, 80)}
    assert kept.count() == len(want) and kept.columns == docs.columns
    assert corpus_pipeline.run(spark, sf_dir).count() > 0

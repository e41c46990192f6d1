"""Repeated phrases against a count of all windows, the automaton against all substrings."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest
from compare import duck, duck_rows, spark_rows

from folio.llm import phrases
from folio.llm.oracle import ORACLE
from folio.llm.queries import QUERIES
from folio.session import shared_root


def plain(rows, length):
    split = [(i, (text or "").encode().split()) for i, text in rows]
    count = Counter(tuple(w[k : k + length]) for _, w in split for k in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - length + 1) if count[tuple(w[k : k + length])] > 1 for j in range(k, k + length)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 7, "k") for i, t in rows], "doc_id long, text string, at int, n long, class string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    known = [f"w{k}" for k in range(60)] + ["é😀", "A", "a"]
    words = lambda n: [rng.choice(known) for _ in range(n)]
    shared = [words(n) for n in (8, 9, 14, 40)]
    out = []
    for i in range(120):
        text = words(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            text += part[a : a + rng.randint(4, 40)] + words(rng.randint(0, 3))
        out.append((i, rng.choice([" ", "  ", "\n", "\t"]).join(text)))
    out += [(200, None), (201, ""), (202, " \n"), (None, out[3][1]), (None, "lone words"), (203, "a " * 400), (204, "b a " * 300)]
    return out + [(205, " ".join(words(50)))] * 3 + [(206, " ".join(words(8))), (207, " ".join(words(7)))]


@pytest.mark.parametrize("options", [{}, {"many": 2}, {"shard_words": 60}, {"many": 4, "shard_words": 200}])
def test_repeated_phrases_go(spark, rows, options):
    want = plain(rows, 8)
    assert found(phrases.remove_phrases(frame(spark, rows), length=8, gram=3, **options)) == want
    assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_one_place_in_many_documents(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(36))
    rows = [(i, f"a{rng.random()} b{rng.random()} {passage} c{rng.random()} d{i % 7}") for i in range(400)]
    assert found(phrases.remove_phrases(frame(spark, rows), many=50, shard_words=1000)) == plain(rows, 35)


def test_tables_behind_the_spans_are_gone_when_texts_are_cut(spark, rows, monkeypatch):
    tables = lambda: set(Path(shared_root(spark)).glob("folio-*/*"))
    cut, there, before = phrases._cut, [], tables()

    def seen(*args):
        there.extend(path.name.rsplit("-", 1)[0] for path in tables() - before)
        return cut(*args)

    monkeypatch.setattr(phrases, "_cut", seen)
    assert found(phrases.remove_phrases(frame(spark, rows), length=8, gram=3)) == plain(rows, 8)
    assert "pieces" in there and not {"anchored", "classes", "places", "contexts", "found", "single"} & set(there)


def test_very_long_and_empty(spark):
    rng = random.Random(9)
    long = " ".join(f"u{rng.randrange(10**9)}" for _ in range(150_000))
    rows = [(1, long), (2, f"x {long[:500_000]} y"), (3, long[700_000:700_900])]
    assert found(phrases.remove_phrases(frame(spark, rows))) == plain(rows, 35)
    assert found(phrases.remove_phrases(frame(spark, []))) == []


def test_statistics_of_the_automaton():
    rng = random.Random(5)
    for _ in range(60):
        texts = [([rng.randrange(3) for _ in range(rng.randint(1, 25))], rng.randint(1, 2)) for _ in range(rng.randint(1, 4))]
        count = Counter()
        for text, n in texts:
            for a in range(len(text)):
                for b in range(a + 1, len(text) + 1):
                    count[tuple(text[a:b])] += n
        automaton = phrases.Automaton()
        for text, n in texts:
            automaton.add(text, n)
        automaton.finish()
        other = [rng.randrange(4) for _ in range(40)]
        for text in [*(t for t, _ in texts), other]:
            want = [max((k for k in range(1, i + 2) if count[tuple(text[i + 1 - k : i + 1])] >= 2), default=0) for i in range(len(text))]
            assert automaton.statistics(text) == want


def test_phrases_sql(spark, sf_dir):
    name = "op13_substring_dedup"
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE[name])

"""Near words against all pairs, forms and roots against following them, and the words of odd texts."""

import random
import re
import zlib
from collections import Counter

import pytest
from compare import duck, duck_rows, spark_rows

from folio.llm import spelling
from folio.llm.oracle import ORACLE
from folio.llm.queries import QUERIES
from folio.session import materialize


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dictionary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("letters, size", [("ab", (4, 9)), ("abcdé", (5, 8)), ("aab", (5, 30))])
def test_near_words_are_all_found(spark, letters, size):
    rng = random.Random(len(letters))
    counts = {}
    while len(counts) < 300:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(*size)))
        counts.setdefault(word, rng.randint(3, 90))
        k = rng.randrange(len(word) + 1)
        other = word[:k] + rng.choice(letters) + word[k + rng.randint(0, 1) :]
        counts.setdefault(other[: size[1]], rng.randint(3, 20))
    counts = {w: n for w, n in counts.items() if len(w) >= size[0]}
    assert found(spelling.variants(dictionary(spark, counts))) == plain(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaabbbbb"[:k] + "c" * 10: 3 * 3**k for k in range(11)}  # each is one edit from the next
    counts |= {"tied": 4, "tieda": 8, "tiedb": 8, "alone": 5}
    want = plain(counts)
    assert found(spelling.variants(dictionary(spark, counts))) == want
    assert len({r[2] for r in want}) < len(want) - 8


def test_no_join_is_by_broadcast(spark, monkeypatch):
    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    counts = {"color": 9, "colour": 30, "colours": 70, "alone": 5}
    words = materialize(dictionary(spark, counts), "words")  # a file, whose size Spark takes for the table's
    monkeypatch.setattr(spelling, "materialize", noted)
    assert found(noted(spelling.variants(words), "variants")) == plain(counts)
    joins = [re.findall(r"\w+Join\b", plan) for plan in plans]
    assert {x for each in joins for x in each} == {"SortMergeJoin"}
    assert sum(bool(each) for each in joins) >= 4  # of pairs, of forms, of roots, of the result


def test_pivots_are_disjoint_and_rarest():
    rng = random.Random(7)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 9)))
        held = [(i, rng.randint(1, 50)) for i in places]
        cost = dict(held)
        best = min(cost[a] + cost[b] for a in places for b in places if b - a >= 2)
        got = spelling.pivots(held)
        assert len(got) == 2 and got[1] - got[0] >= 2 and sum(map(cost.get, got)) == best


def test_words_of_texts(spark):
    rng = random.Random(2)
    known = ["Straße", "ÉTUDE", "étude", "color", "colour", "naïveté×", "x" * 40, "don't", "abcde1fghij"]
    rows = [(k, " ".join(rng.choice(known) for _ in range(30)), 7) for k in range(60)]
    rows += [(None, "Color colour\ncolour", 7), (1, None, 7), (2, "", 7), (3, "Color " * 200_000, 7)] + [(4, "twins twins", 7)] * 2
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    assert found(spelling.spelling_report(docs)) == plain(counts)
    assert found(spelling.spelling_report(docs.filter("false"))) == []


def test_shorter_words_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.near_words(dictionary(spark, {"abc": 3}))


def test_spelling_sql(spark, sf_dir):
    name = "op12_spelling_variants"
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE[name])

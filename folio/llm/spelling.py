"""Spelling variants: words one edit apart, by pivotal grams, and the most frequent form each goes back to.

A word's bigrams are ordered by how few words of the dictionary hold them. Its *prefix* is its three rarest bigrams,
with all places of the third; its *pivots* are the two bigrams of the prefix that do not overlap and are rarest
together, chosen by dynamic programming. One edit leaves a pivot whole, and of two words one has all its
bigrams up to its prefix's end in the other's prefix. So words one edit apart are met when pivots are looked up in the
prefixes of words whose prefix ends no earlier.

Position limits are sharp for one edit: it lies on one side of the whole pivot, so up to the pivot's other end
both words are the same, and the pivot is as far from that end in both. A pivot is therefore indexed twice, by what stands
up to its end and by what stands from its start on. Where that is short, one half of the rest is part of the
key too, the first or the last, since one edit leaves one of them whole. Every candidate is verified by its edit distance.

A word's form is its most frequent near word, the first in code-point order on ties, if it is at least
twice as frequent; its root is the end of the chain of forms. Frequencies double along a chain, so the pointer
jumps that find the ends are few.

Joins are by merge at every size. Spark takes the keys for about as many rows as there are words, of which each has a
dozen, and a table for as large as its compressed file; so it would broadcast more than a driver holds.

Null and empty texts have no words, repeated rows count again, an empty table gives an empty result; a null id counts
as the empty text. Words may be of any length from ``LEAST_LETTERS`` on. Columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import texts
from folio.session import materialize, scratch

#: Letters of a word, once A-Z are in lower case; two of them are at most 8,100 bigrams.
LETTERS = "a-zÀ-ÿ"
SHORTEST, LEAST = 5, 3
LEAST_LETTERS = 4  # shorter words have no three bigrams
GRAM, EDITS = 2, 1
_WHOLE = 6  # from so many letters on, what is up to the pivot is the whole key
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _one_letter_lost(doc_id: Column, run: Column, every: int) -> Column:
    """``run`` without one letter where ``every`` divides the checksum of the id and the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def count_words(docs: DataFrame, every: int = 97, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word, n`` over all texts, after the contract's loss of letters; partial counts leave each task."""
    lowered = F.translate("text", _UPPER, _LOWER)
    runs = texts(docs).select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("run"))
    words = runs.select(_one_letter_lost(F.col("doc_id"), F.col("run"), every).alias("word")).filter(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def count_grams(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank, from the rarest on, and count of each bigram: as many as there are pairs of letters."""
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM))))
    rows = words.select(grams.alias("gram")).groupBy("gram").count().toArrow().to_pylist()
    rows.sort(key=lambda r: (r["count"], r["gram"]))
    return {r["gram"]: (k, r["count"]) for k, r in enumerate(rows)}


def prefix(word: str, grams: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """Places and counts of the bigrams up to the third rarest, all its places included; and the rank it ends with."""
    held = [(*grams[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1)]
    last = sorted(held)[GRAM * EDITS][0]
    return [(i, n) for rank, n, i in held if rank <= last], last


def pivots(places: list[tuple[int, int]]) -> list[int]:
    """The places of ``EDITS + 1`` bigrams that do not overlap, of least count together; ``places`` is in order."""
    # best[j]: least count of j bigrams among those that end before the one in hand, and their places
    best: list[list[tuple[int, list[int]]]] = [[(0, [])] + [(1 << 62, [])] * (EDITS + 1)]
    free = 0
    for k, (at, n) in enumerate(places):
        while free < k and places[free][0] + GRAM <= at:
            free += 1
        taken = [(c + n, [*chosen, at]) for c, chosen in best[free][: EDITS + 1]]
        best.append([best[k][0], *[min(a, b) for a, b in zip(best[k][1:], taken)]])
    return best[-1][EDITS + 1][1]


def keys(word: str, places: list[int]) -> Iterator[tuple[int, bool]]:
    """Hashes under which a bigram at each place is indexed or looked up, and whether for a rest one shorter than the word's."""
    import xxhash

    for at in places:
        for side, same, rest in (("<", word[: at + GRAM], word[at + GRAM :]), (">", word[at:], word[:at][::-1])):
            if len(same) >= _WHOLE:
                yield xxhash.xxh64_intdigest(side + same), False
                continue
            for size, shorter in ((len(rest), False), (len(rest) - 1, True)):
                half = size // 2
                if half:
                    yield xxhash.xxh64_intdigest(f"{side}{same}{size}^{rest[:half]}"), shorter
                    yield xxhash.xxh64_intdigest(f"{side}{same}{size}${rest[-half:]}"), shorter
                elif size >= 0:
                    yield xxhash.xxh64_intdigest(f"{side}{same}{size}"), shorter


def _keyed(words: DataFrame, shared, pivotal: bool) -> DataFrame:
    """``key, shorter, last, word``: a row for each key of the word's pivots, or of its whole prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        for batch in batches:
            own = batch.column(0).to_pylist()
            for begin in range(0, len(own), 2000):
                found, shorter, last, owner = [], [], [], []
                for k, word in enumerate(own[begin : begin + 2000], begin):
                    places, end = prefix(word, grams)
                    at = pivots(places) if pivotal else [i for i, _ in places]
                    for key, less in keys(word, at):
                        found.append(key)
                        shorter.append(less)
                        last.append(end)
                        owner.append(k)
                columns = [pa.array(np.array(found, np.uint64).view(np.int64)), pa.array(shorter), pa.array(last, pa.int32()), batch.column(0).take(pa.array(owner, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "shorter", "last", "word"])

    return words.select("word").mapInArrow(run, "key long, shorter boolean, last int, word string")


def near_words(words: DataFrame) -> DataFrame:
    """``word, other`` for all words of the dictionary one edit apart, each pair in both orders; written once."""
    if words.filter(F.char_length("word") < LEAST_LETTERS).limit(1).count():
        raise ValueError(f"words of fewer than {LEAST_LETTERS} letters have no pivots")
    shared = words.sparkSession.sparkContext.broadcast(count_grams(words))
    a, b = _keyed(words, shared, True).alias("a"), _keyed(words, shared, False).alias("b")
    c = F.col
    met = (c("a.key") == c("b.key")) & (c("a.last") <= c("b.last")) & ~(c("a.shorter") & c("b.shorter"))
    near = (c("a.word") != c("b.word")) & (F.levenshtein("a.word", "b.word", EDITS) == EDITS)
    pairs = a.hint("merge").join(b, met & near).select(F.least("a.word", "b.word").alias("x"), F.greatest("a.word", "b.word").alias("y")).distinct()
    pairs = materialize(pairs, "pairs")
    shared.destroy()
    return pairs.select(c("x").alias("word"), c("y").alias("other")).union(pairs.select("y", "x"))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` for words with a form: each step doubles the way that is known."""
    at = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = at.hint("merge").join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        step = materialize(step, "roots")
        at = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return at


def variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a dictionary ``word, n``."""
    c = F.col
    near = near_words(words).hint("merge").join(words.select(c("word").alias("other"), c("n").alias("_n")), "other")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-c("_n")).alias("less"), "other")).alias("_best"))
    more = -c("_best.less")
    frequent = more >= 2 * c("n")
    rows = words.hint("merge").join(best, "word", "left").select(
        "word",
        F.when(frequent, c("_best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, more).alias("form_n"),
    )
    rows = materialize(rows, "forms")
    roots = _roots(rows.filter("form IS NOT NULL"))
    return rows.hint("merge").join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame) -> DataFrame:
    """The contract's rows for all words of ``docs``."""
    with scratch(docs.sparkSession) as keep:
        return keep(variants(materialize(count_words(docs), "words")), "variants")

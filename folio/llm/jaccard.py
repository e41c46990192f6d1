"""N-gram Jaccard join by T-occurrence search with divided lists.

A document is the set of its distinct three-word shingles (64-bit hashes); equal sets are one *class*. A partner
of a class with n shingles shares at least T = ceil(0.9 n) of them. Its shingles' inverted lists are divided
by length: the n - T + c shortest are merged, and a partner must occur there at least c times; the T - c longest
are never merged but probed, by bisection in the partner's sorted shingles, which gives the exact overlap.
Which lists are short is decided by a sketch of shingle frequencies of fixed size: any order that all
documents share is exact, a good one keeps lists of common passages out of the merge.

Long lists of near copies would still yield all pairs. So classes are linked first to one class of each
short list (of nearly equal size), and the components of the links that hold are found. What remains to be
searched is each list's classes outside its commonest component against the whole list, in long lists only by
their differences to one class for the list: near copies below the threshold meet where they differ alike, not in all they
have in common. The candidates of this search are complete, so no link between two components is missed.

Null, empty and blank texts have no shingles and stand alone. With fewer words than a shingle the whole
sequence is the one shingle. Repeated rows fall into one class; rows that share an id are told apart by
text. A row without an id is linked like any other; a component whose ids are all null has the id null. An empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, forget, texts, tidied, words_of
from folio.llm.components import components
from folio.session import materialize, scratch

SKETCH_BITS = 20
#: Lists of more classes are long in the search across components.
LONG = 64
#: Shingles, of those in which two classes differ alike from a third, that are looked for.
MEET = 2
_SLICES = 64
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5)]


class Shingles:
    """Sorted distinct shingle hashes of a text; word hashes are remembered for a bounded number of words."""

    def __init__(self, size: int, room: int = 200_000):
        import xxhash

        digest = xxhash.xxh64_intdigest

        class Known(dict):
            def __missing__(self, word):
                value = self[word] = digest(word)
                return value

        self.known, self.size, self.room = Known(), size, room

    def of(self, text: str) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.room:
            self.known.clear()
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(words) - size + 1
        total = h[:n] * _M[0]
        for k in range(1, size):
            total = (total ^ (total >> np.uint64(29))) * _M[4] + h[k : k + n] * _M[k % 4]
        total ^= total >> np.uint64(32)
        total *= _M[3]
        total ^= total >> np.uint64(29)
        total.sort()
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


def key_of(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def _summed(parts: DataFrame) -> dict[int, bytes]:
    """By slice, the sum of vectors that come as rows ``slice, body`` (32-bit counts)."""
    import pandas as pd

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in frame["body"])
        return pd.DataFrame({"slice": [int(frame["slice"].iloc[0])], "body": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})

    return {r.slice: bytes(r.body) for r in parts.groupBy("slice").applyInPandas(add, "slice int, body binary").collect()}


def frequency_sketch(docs: DataFrame, size: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts of shingles by hash, ``2 ** bits`` counters over all documents; the driver gets only their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts, shingles = np.zeros(1 << bits, np.int32), Shingles(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                held = [shingles.of(t) for t in batch.column(0).slice(at, 1000).to_pylist()]
                places = (np.concatenate(held) & np.uint64((1 << bits) - 1)).astype(np.int64)
                counts += np.bincount(places, minlength=1 << bits).astype(np.int32)
        parts = [p.tobytes() for p in np.split(counts, _SLICES)]
        some = [k for k, p in enumerate(parts) if p.strip(b"\0")]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k] for k in some], pa.binary())], ["slice", "body"])

    rows = _summed(texts(docs).select("text").mapInArrow(tidied(run), "slice int, body binary"))
    empty = np.zeros((1 << bits) // _SLICES, np.int32).tobytes()
    return np.frombuffer(b"".join(rows.get(k, empty) for k in range(_SLICES)), np.int32)


def least_overlap(n: np.ndarray | int, percent: int):
    return -(-n * percent // 100)


def occurrences(n: int) -> int:
    """c: how often a partner must occur in the short lists."""
    return 3 if n >= 30 else 1


_OCC = "CASE WHEN n >= 30 THEN 3 ELSE 1 END"


def short_lists(docs: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``doc_id, mark, n, key, short``: set size, class, and the shingles whose lists are merged."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def make():
        counts, shingles = shared.value, Shingles(size)
        mask = np.uint64(len(counts) - 1)

        def step(batch: pa.RecordBatch) -> dict:
            n, key, short, ends = [], [], [], [0]
            for text in (x.as_py() for x in batch.column(2)):
                s = shingles.of(text)
                n.append(len(s))
                if not len(s):
                    key.append(None)
                    ends.append(ends[-1])
                    continue
                key.append(key_of(s))
                c = occurrences(len(s))
                lists = min(len(s), len(s) - least_overlap(len(s), percent) + c)
                order = np.argsort(counts[(s & mask).astype(np.int64)], kind="stable")  # ties by hash
                short.append(s[order[:lists]].view(np.int64))
                ends.append(ends[-1] + lists)
            values = np.concatenate(short) if short else np.zeros(0, np.int64)
            arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            return {"doc_id": batch.column(0), "mark": batch.column(1), "n": pa.array(n, pa.int64()), "key": pa.array(key, pa.int64()), "short": arrays}

        return step

    return arrow_map(_marked(docs), make, "doc_id long, mark long, n long, key long, short array<long>")


def row_mark() -> Column:
    """A hash of a row's id and text, by which its class finds it again, null ids included."""
    return F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))


def _marked(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", row_mark().alias("mark"), "text")


def sets_of(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """``key, body``: the sorted shingles of the classes in ``wanted`` (``key, mark``), as bytes.

    A filter of fixed size over the wanted rows spares most other documents the work; what it lets
    through in error is dropped by the join.
    """
    bits = 23

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, np.int32)
        for batch in batches:
            seen[_places(batch.column(0), bits)] = 1
        packed = np.packbits(seen.astype(bool)).view(np.int8)
        parts = np.split(packed, _SLICES)
        some = [k for k, p in enumerate(parts) if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some], pa.binary())], ["slice", "body"])

    import pandas as pd

    def either(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in frame["body"]])
        return pd.DataFrame({"slice": [int(frame["slice"].iloc[0])], "body": [total.tobytes()]})

    marks = wanted.select("mark").mapInArrow(mark, "slice int, body binary").groupBy("slice").applyInPandas(either, "slice int, body binary")
    rows = {r.slice: r.body for r in marks.collect()}
    none = bytes((1 << bits) // 8 // _SLICES)
    shared = docs.sparkSession.sparkContext.broadcast(b"".join(rows.get(k, none) for k in range(_SLICES)))

    def make():
        seen = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        shingles = Shingles(size)

        def step(batch: pa.RecordBatch) -> dict:
            column = batch.column(1)
            key, body = [], []
            for k in np.flatnonzero(seen[_places(batch.column(0), bits)]):
                s = shingles.of(column[int(k)].as_py())
                if len(s):
                    key.append(key_of(s))
                    body.append(s.tobytes())
            return {"key": pa.array(key, pa.int64()), "body": pa.array(body, pa.binary())}

        return step

    found = arrow_map(_marked(docs).select("mark", "text"), make, "key long, body binary")
    return found.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.min("body").alias("body"))


def _places(marks: pa.Array, bits: int) -> np.ndarray:
    x = marks.to_numpy().view(np.uint64) * _M[0]
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def _with_sets(pairs: DataFrame, sets: DataFrame, *more: str) -> DataFrame:
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("body").alias("_x")), "a")
    return both.join(sets.select(F.col("key").alias("b"), F.col("body").alias("_y")), "b").select("a", "b", *more, "_x", "_y")


def holding(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the overlap, counted by bisection of one set in the other."""
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            kept = []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * same >= percent * (len(x) + len(y) - same):
                    kept.append(k)
            rows = pa.array(kept, pa.int64())
            return {"a": batch.column(0).take(rows), "b": batch.column(1).take(rows)}

        return step

    return arrow_map(_with_sets(pairs, sets), make, "a long, b long")


def jaccard_classes(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; a component's id is null where all its ids are."""
    rows, roots = _components(docs, size, percent)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    members = roots.join(least, "root").select("key", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "key").join(members, "key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, mark, group`` for every row: rows have the same group if links join them, whatever their ids."""
    rows, roots = _components(docs, size, percent)
    joined = rows.join(roots.select("key", "root"), "key", "left")
    alone = F.struct(F.lit(1).alias("alone"), F.xxhash64("doc_id", "mark").alias("of"))
    group = F.when(F.col("root").isNull(), alone).otherwise(F.struct(F.lit(0).alias("alone"), F.col("root").alias("of")))
    return joined.select("doc_id", "mark", group.alias("group"))


def _components(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``short_lists``; and ``key, least, root`` of every class: its least id and its component."""
    with scratch(docs.sparkSession) as keep:
        sketch = frequency_sketch(docs, size)
        rows = keep(short_lists(docs, size, percent, sketch), "short")
        return rows, _members(rows, docs, size, percent, sketch, keep)


def _members(rows: DataFrame, docs: DataFrame, size: int, percent: int, sketch: np.ndarray, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    c = F.col
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.min("mark").alias("mark"), F.first("n").alias("n"))
    classes = materialize(classes, "classes")
    # Rows of one class have the same lists.
    postings = rows.filter("n > 0").dropDuplicates(["key"]).select("key", "n", F.explode("short").alias("h"))
    often = postings.groupBy("h").agg(F.count("*").alias("_in_list")).filter("_in_list > 1")
    lists = materialize(postings.join(often, "h"), "lists")
    by_class = classes.select("key", "mark")
    links = _holding(lambda: _leading_pairs(lists, percent), docs, size, percent, by_class)
    roots = materialize(components(links), "roots")
    differ = None
    if long_ := _long_lists(lists, links, roots, docs, size, percent, by_class, sketch):
        differ, links = long_
        roots = materialize(components(links), "roots")
    more = _holding(lambda: _search(lists, roots, percent, differ), docs, size, percent, by_class)
    if not more.isEmpty():
        roots = materialize(components(links.union(more)), "roots")
    rooted = classes.select("key", "least").join(roots.select(c("node").alias("key"), "root"), "key", "left")
    return keep(rooted.select("key", "least", F.coalesce("root", "key").alias("root")), "members")


def _holding(candidates: Callable[[], DataFrame], docs: DataFrame, size: int, percent: int, by_class: DataFrame) -> DataFrame:
    """The candidate pairs that hold; what was written to check them goes."""
    with scratch(docs.sparkSession) as keep:
        pairs = materialize(candidates(), "pairs")
        return keep(holding(pairs, _needed(docs, size, pairs, by_class), percent), "links")


def _leading_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each class with the least class of a list and size band, for lists in which the two meet often."""
    step = F.log(F.lit(100.0 / percent))
    found = None
    for shift in (0.0, 0.5):
        banded = lists.withColumn("_band", F.floor(F.log("n") / step + F.lit(shift)).cast("int"))
        lead = banded.groupBy("h", "_band").agg(F.min("key").alias("b"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
        pairs = banded.join(lead, ["h", "_band"]).filter(F.col("key") != F.col("b")).groupBy(F.col("key").alias("a"), "b").agg(F.count("*").alias("_met"), F.first("n").alias("n"))
        pairs = pairs.filter(f"_met >= {_OCC}").select("a", "b")
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def _up(value, by: int):
    """Whole-number division, rounded up."""
    return F.call_function("div", value + (by - 1), F.lit(by))


def _needed(docs: DataFrame, size: int, pairs: DataFrame, by_class: DataFrame) -> DataFrame:
    """The sets of the classes in ``pairs``."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    return materialize(sets_of(docs, size, materialize(keys.join(by_class, "key"), "wanted")), "sets")


def _placed(lists: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """The rows of lists with several components: of a class its size ``n``, its short lists ``p``, ``u`` of them not long."""
    c = F.col
    least = _up(c("n") * percent, 100)
    merged = F.least(c("n"), c("n") - least + F.expr(_OCC))
    long_ = lists.groupBy("key").agg(F.sum((c("_in_list") > LONG).cast("long")).alias("_long"))
    placed = lists.join(long_, "key").select("h", "key", "n", merged.alias("p"), (merged - c("_long")).alias("u"), c("_in_list").alias("top"))
    return _mixed(placed, roots, ["h"])


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their ``key``; a class without links is its own."""
    return rows.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def _mixed(rows: DataFrame, roots: DataFrame, on: list[str]) -> DataFrame:
    """The rows of lists with several components, with their ``root``, and whether that is ``_in`` most rows of the list."""
    rooted = _rooted(rows, roots)
    per = rooted.groupBy(*on, "root").agg(F.count("*").alias("_n"))
    several = per.groupBy(*on).agg(F.max(F.struct("_n", "root"))["root"].alias("_main"), F.count("*").alias("_roots")).filter("_roots > 1")
    return rooted.join(several.drop("_roots"), on).withColumn("_in", F.col("root") == F.col("_main")).drop("_main")


def _across(rows: DataFrame, on: list[str], percent: int, also: Column) -> DataFrame:
    """Pairs of a list's rows from different components, sizes permitting; a pair's columns end with ``a`` and ``b``."""
    c = F.col
    of = {name: "" if name == "key" else name[0] for name in rows.columns if name not in (*on, "_in")}
    few = rows.filter(~c("_in")).select(*on, *[c(x).alias(y + "a") for x, y in of.items()])
    all_ = rows.select(*on, *[c(x).alias(y + "b") for x, y in of.items()], "_in")
    fits = (c("na") * 100 >= c("nb") * percent) & (c("nb") * 100 >= c("na") * percent)
    met = few.join(all_, on).filter((c("ra") != c("rb")) & fits & (c("_in") | (c("a") < c("b"))) & also)
    return met.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})


def _bounds(percent: int) -> tuple[Column, Column]:
    """What a pair has to share, and how often it has to meet in lists that are not long."""
    c = F.col
    share = _up((c("na") + c("nb")) * percent, 100 + percent)
    return share, F.least(c("ua") - c("na") + share, c("ub") - c("nb") + share)


def _search(lists: DataFrame, roots: DataFrame, percent: int, differ: DataFrame | None) -> DataFrame:
    """Candidate pairs of classes in different components.

    Lists beyond ``LONG`` classes are divided from the rest once more. Let a have n shingles, u of its short lists
    not long, and let a partner have to share v: it may miss n - v of a's shingles, so it shares at least
    u - (n - v) of the u. The one of a pair whose short lists end first in the common order finds all it shares
    of them in the other's short lists. So where the number is 1 or more for both, the pair meets that often in
    lists that are not long; the other pairs meet there as often as they have to in all, or in a long list. Those
    of a long list are looked for by their differences to one class (``differ``): let x and y be how many shingles only
    one of a or b and that class has, and m the most in which a and b may differ. With x + y <= m both are
    linked to that class. Else their differences have t = (x + y - m) / 2 shingles in common, rounded up, the first ``MEET`` of
    them early in any order that all share. What near copies have in common is in no difference, so they meet only
    where they differ alike.
    """
    c = F.col
    share, bound = _bounds(percent)
    of_pair = [bound.alias("bound"), (share - F.greatest(c("na") - c("pa"), c("nb") - c("pb"))).alias("least")]
    rows = materialize(_placed(lists, roots, percent).filter(c("top") <= LONG).drop("top"), "mixed")
    met = _across(rows, ["h"], percent, F.lit(True)).select("a", "b", *of_pair)
    met = met.groupBy("a", "b").agg(F.count("*").alias("_met"), F.first("bound").alias("bound"), F.first("least").alias("least"))
    pairs = met.filter(c("_met") >= F.when(c("bound") > 0, c("bound")).otherwise(c("least"))).select("a", "b")
    if differ is None:
        return pairs
    rows = materialize(_mixed(differ, roots, ["lead", "e"]), "mixed")
    t = F.greatest(F.lit(1), _up(c("xa") + c("xb") - (c("na") + c("nb") - 2 * share), 2))
    early = (bound <= 0) & (t <= c("xa")) & (t <= c("xb")) & (c("ia") < c("xa") - t + MEET) & (c("ib") < c("xb") - t + MEET)
    met = _across(rows, ["lead", "e"], percent, early).select("lead", "a", "b", F.least(t, F.lit(MEET)).alias("t"))
    met = met.groupBy("lead", "a", "b").agg(F.count("*").alias("_met"), F.first("t").alias("t"))
    return pairs.union(met.filter("_met >= t").select("a", "b")).distinct()


def _long_lists(lists: DataFrame, links: DataFrame, roots: DataFrame, docs: DataFrame, size: int, percent: int, by_class: DataFrame, sketch: np.ndarray) -> tuple[DataFrame, DataFrame] | None:
    """How classes in long lists differ from one class, the lead of the list; ``links``, and those to that class and among classes that differ alike.

    The rows ``key, n, u, lead, x, i, e`` name the first shingles ``e`` of the difference, from 0, of all ``x``.
    """
    c = F.col
    with scratch(docs.sparkSession) as keep:
        rows = materialize(_placed(lists, roots, percent).filter(c("top") > LONG), "long")
        # Any class does for a list; the root of its commonest component is the same for most lists of a group of near copies.
        lead = rows.filter("_in").groupBy("h").agg(F.min("root").alias("lead"))
        led = rows.join(lead, "h").filter("key != lead").groupBy(c("key").alias("a"), c("lead").alias("b"))
        pairs = materialize(led.agg(F.first("n").alias("n"), F.first("u").alias("u")), "to_lead")
        if pairs.isEmpty():
            return None
        sets = _needed(docs, size, pairs, by_class)
        far = materialize(differences(pairs, sets, percent, sketch), "differences")
        differ = far.select(c("a").alias("key"), "n", "u", c("b").alias("lead"), c("far").alias("x"), F.posexplode("first").alias("i", "e"))
        differ = keep(differ, "differ")
        links = links.union(far.filter("links").select("a", "b"))
        near = materialize(_to_hubs(_rooted(differ, roots)), "to_hub")
        links = keep(links.union(holding(near, sets, percent)).distinct(), "links")
        return differ, links


def _to_hubs(rows: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of classes that differ alike, in different components: each with the one nearest to the lead.

    That one is the likeliest to be linked to the others. Lists of one component are left out as they are summed up,
    so a row meets its list's one hub, and only if that is in another component.
    """
    c = F.col
    hubs = rows.groupBy("lead", "e").agg(F.min(F.struct("x", "key", "root")).alias("hub"), F.max("root").alias("_most"), F.min("root").alias("_least"))
    hubs = hubs.filter("_most != _least").select("lead", "e", c("hub.key").alias("_hub"), c("hub.root").alias("_of"))
    met = rows.join(hubs, ["lead", "e"]).filter("root != _of")
    return met.select(F.least("key", "_hub").alias("a"), F.greatest("key", "_hub").alias("b")).distinct()


def differences(pairs: DataFrame, sets: DataFrame, percent: int, sketch: np.ndarray) -> DataFrame:
    """``a, b, n, u, far, links, first`` for ``a, b, n, u``: how many shingles only one has, whether the pair holds, the first of these shingles.

    Those come first that few classes near ``b`` should have in their own difference to it: shingles of ``b`` are missing
    rarely where they are frequent, and other classes near it miss some of them.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(sketch)

    def make():
        counts = shared.value
        mask = np.uint64(len(counts) - 1)

        def step(batch: pa.RecordBatch) -> dict:
            far, links, first, ends = [], [], [], [0]
            for x, y in zip(batch.column(4), batch.column(5)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                only = np.setxor1d(x, y, assume_unique=True)
                both = (len(x) + len(y) - len(only)) // 2
                often = counts[(only & mask).astype(np.int64)]
                most = counts[(y & mask).astype(np.int64)].max()
                often = np.where(np.isin(only, y, assume_unique=True), most - often + most // 8, often)
                kept = only[np.argsort(often, kind="stable")[: len(x) * (100 - percent) // percent + MEET]]  # ties by hash
                far.append(len(only))
                links.append(100 * both >= percent * (both + len(only)))
                first.append(kept.view(np.int64))
                ends.append(ends[-1] + len(kept))
            arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(first)))
            return {**{name: batch.column(k) for k, name in enumerate("abnu")}, "far": pa.array(far, pa.int64()), "links": pa.array(links, pa.bool_()), "first": arrays}

        return step

    return arrow_map(_with_sets(pairs, sets, "n", "u"), make, "a long, b long, n long, u long, far long, links boolean, first array<long>")

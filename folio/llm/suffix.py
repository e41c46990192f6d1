"""Repeated strings removed by a hash-compared suffix sort.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed. A string's *anchor*
is its least ``gram``-byte hash, the leftmost on a tie; equal strings have equal anchors at equal distances,
so a repeated string is found among the suffixes that start at one distance before one anchor.

1. Each text is cut into runs of strings with a common anchor. Equal texts are one class, of which only one
   goes on; anchors met once in all classes are dropped.
2. What surrounds a repeated anchor is its *context*. Equal contexts are counted: all their strings repeat.
3. Where an anchor has several contexts, their suffixes are sorted by merging. Two suffixes are compared by
   bisection for their common extension over prefix polynomial hashes; neighbours whose extension reaches
   ``length`` are repeated, once their bytes have been compared. Anchors with more than ``block`` contexts are
   first spread by the hashes of their strings, so no task gets them all.
4. Spans go back to the texts by class.

Null and empty texts have no bytes and lose none; texts shorter than ``length`` lose none. Rows that repeat
are copies of each other and lose all bytes when long enough. An empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, texts
from folio.session import materialize

BLOCK = 1000
_EMPTY = hashlib.sha256(b"").hexdigest()


class Polynomial:
    """Prefix hashes modulo 2**64 over byte values spread by a random table."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.spread = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.base = np.uint64(int(rng.integers(1, 2**62)) * 2 + 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.pow = np.ones(1, np.uint64)
        self.inv = np.ones(1, np.uint64)

    def room(self, n: int) -> None:
        if len(self.pow) < n:
            size = max(n, 1 << 16)
            for name, base in (("pow", self.base), ("inv", self.inverse)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def prefix(self, body: np.ndarray) -> np.ndarray:
        self.room(len(body) + 1)
        out = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(self.spread[body] * self.pow[: len(body)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, at: np.ndarray, size) -> np.ndarray:
        return (prefix[at + size] - prefix[at]) * self.inv[at]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def runs(body: np.ndarray, length: int, gram: int, poly: Polynomial) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last string of each run of strings with one anchor."""
    strings = len(body) - length + 1
    if strings <= 0:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    prefix = poly.prefix(body)
    grams = len(body) - gram + 1
    hashes = _mix((prefix[gram:] - prefix[:-gram]) * poly.inv[:grams])
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    width = length - gram + 1
    padded = np.full(-(-grams // width) * width, np.uint64(2**64 - 1))
    padded[:grams] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:strings], ahead[width - 1 : width - 1 + strings])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [strings]]) - 1
    return hashes[anchor[first]], anchor[first], first, last


def _key(data: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(data)


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, n_bytes, key, sha, grams``: the text's class and hash, its anchors once, or twice where met more often."""

    def make():
        poly = Polynomial()

        def step(batch: pa.RecordBatch) -> dict:
            n, key, sha, ends, values = [], [], [], [0], []
            for text in batch.column(1).to_pylist():
                data = text.encode()
                n.append(len(data))
                key.append(_key(data))
                sha.append(hashlib.sha256(data).hexdigest())
                h = runs(np.frombuffer(data, np.uint8), length, gram, poly)[0]
                if len(h):
                    h, count = np.unique(h, return_counts=True)
                    h = np.concatenate([h, h[count > 1]]).view(np.int64)
                    values.append(h)
                ends.append(ends[-1] + len(h))
            flat = np.concatenate(values) if values else np.zeros(0, np.int64)
            return {"doc_id": batch.column(0), "n_bytes": pa.array(n, pa.int64()), "key": pa.array(key, pa.binary()), "sha": sha, "grams": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))}

        return step

    return arrow_map(texts(docs), make, "doc_id long, n_bytes long, key binary, sha string, grams array<long>")


def contexts(wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts of the repeated anchors of each class (``key, text, grams``): one row for equal ones of a text.

    ``near`` and ``far`` are the least and greatest distance of a string before the anchor, ``at`` the
    places of the anchor as 32-bit numbers, ``body`` the bytes from the farthest string's start on.
    """

    def make():
        poly = Polynomial()

        def step(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("key", "gram", "near", "far", "context", "n", "at", "body")}
            for k, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                data = text.encode()
                h, place, first, last = runs(np.frombuffer(data, np.uint8), length, gram, poly)
                repeated = np.isin(h.view(np.int64), batch.column(2)[k].values.to_numpy(zero_copy_only=False))
                found: dict[tuple, list] = {}
                for i in np.flatnonzero(repeated).tolist():
                    body = data[first[i] : last[i] + length]
                    found.setdefault((int(h[i]), int(place[i] - last[i]), int(place[i] - first[i]), body), []).append(int(place[i]))
                for (gram_, near, far, body), at in found.items():
                    out["key"].append(key)
                    out["gram"].append(gram_ - (1 << 64) if gram_ >> 63 else gram_)
                    out["near"].append(near)
                    out["far"].append(far)
                    out["context"].append(_key(body))
                    out["n"].append(len(at))
                    out["at"].append(np.array(at, "<i4").tobytes())
                    out["body"].append(body)
            kinds = {"key": pa.binary(), "gram": pa.int64(), "near": pa.int32(), "far": pa.int32(), "context": pa.binary(), "n": pa.int64(), "at": pa.binary(), "body": pa.binary()}
            return {k: pa.array(v, kinds[k]) for k, v in out.items()}

        return step

    schema = "key binary, gram long, near int, far int, context binary, n long, at binary, body binary"
    return arrow_map(wanted.select("key", "text", "grams"), make, schema)


class SuffixSorter:
    """Sorts suffixes of a buffer inside groups, compared up to ``length`` bytes."""

    def __init__(self, body: np.ndarray, length: int, poly: Polynomial):
        self.body, self.length, self.poly = body, length, poly
        self.prefix = poly.prefix(body)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at ``a`` and ``b``, by bisection over hashes of their beginnings."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.poly.of(self.prefix, a, mid) == self.poly.of(self.prefix, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at ``a`` comes before, with or after the one at ``b``."""
        n = self.extension(a, b)
        end = len(self.body) - 1
        x, y = self.body[np.minimum(a + n, end)].astype(np.int16), self.body[np.minimum(b + n, end)].astype(np.int16)
        return np.where(n >= self.length, 0, np.sign(x - y))

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of ``starts`` by group, then suffix: runs of 1, 2, 4 ... are merged in all groups at once."""
        order = np.argsort(group, kind="stable")
        g = group[order]
        begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sizes = np.diff(np.append(begin, len(g)))
        base = np.repeat(begin, sizes)
        size = np.repeat(sizes, sizes)
        local = np.arange(len(g)) - base
        width, top = 1, int(sizes.max(initial=0))
        while width < top:
            items = starts[order]
            pair = local // (2 * width) * (2 * width)
            right = local - pair >= width
            other = np.where(right, pair, pair + width)
            low = np.zeros(len(g), np.int64)
            high = np.clip(np.where(right, width, size - other), 0, width)
            live = np.flatnonzero(low < high)
            while len(live):
                mid = (low[live] + high[live]) // 2
                c = self.order(items[base[live] + other[live] + mid], items[live])
                before = np.where(right[live], c <= 0, c < 0)
                low[live[before]] = mid[before] + 1
                high[live[~before]] = mid[~before]
                live = live[low[live] < high[live]]
            place = base + pair + (local - np.where(right, pair + width, pair)) + low
            after = np.empty_like(order)
            after[place] = order
            order = after
            width *= 2
        return order

    def repeated(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Which suffixes share ``length`` bytes with another of their group; bytes are compared, not only hashes."""
        out = np.zeros(len(starts), bool)
        if not len(starts):
            return out
        order = self.sort(starts, group)
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(group[a] == group[b])
        near = near[self.extension(starts[a[near]], starts[b[near]]) >= self.length]
        for at in range(0, len(near), 20_000):
            part = near[at : at + 20_000]
            reach = np.arange(self.length)
            same = (self.body[starts[a[part], None] + reach] == self.body[starts[b[part], None] + reach]).all(1)
            out[a[part[same]]] = out[b[part[same]]] = True
        return out


def _intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


_ID = ["gram", "near", "far", "context"]
_FOUND = "gram long, near int, far int, context binary, spans array<struct<a int, b int>>"


def sort_contexts(rows: DataFrame, length: int, chunk: int = 1 << 21) -> DataFrame:
    """Repeated distances ``spans`` of each context; all contexts of an anchor are in one task, side by side."""
    span_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def solve(held: list[tuple], poly: Polynomial) -> pa.RecordBatch:
        bodies = [r[4] for r in held]
        body = np.frombuffer(b"".join(bodies), np.uint8)
        offset = np.concatenate([[0], np.cumsum([len(x) for x in bodies])])
        _, number = np.unique(np.array([r[0] for r in held], np.int64), return_inverse=True)
        near, far = np.array([r[1] for r in held]), np.array([r[2] for r in held])
        count = far - near + 1
        owner = np.repeat(np.arange(len(held)), count)
        back = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)  # 0 is the farthest string
        group = number.ravel()[owner] * (int(far.max()) + 1) + far[owner] - back
        _, place, sizes = np.unique(group, return_inverse=True, return_counts=True)
        some = np.flatnonzero(sizes[place.ravel()] > 1)
        flags = np.zeros(len(owner), bool)
        flags[some] = SuffixSorter(body, length, poly).repeated(offset[owner[some]] + back[some], group[some])
        edge = np.cumsum(count) - count
        spans = [[{"a": int(far[k]) - y, "b": int(far[k]) - x} for x, y in _intervals(flags[edge[k] : edge[k] + count[k]])] for k in range(len(held))]
        kept = [k for k, s in enumerate(spans) if s]
        columns = [pa.array([held[k][c] for k in kept], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([spans[k] for k in kept], span_type)], [*_ID, "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, poly = [], 0, Polynomial()
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if size > chunk and row[0] != held[-1][0]:
                    yield solve(held, poly)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve(held, poly)

    return rows.select(*_ID, "body").repartition("gram").sortWithinPartitions("gram").mapInArrow(run, _FOUND)


def spread_contexts(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: strings meet by distance and two hashes, counted before they move."""

    def make():
        polys = Polynomial(11), Polynomial(12)

        def step(batch: pa.RecordBatch) -> dict:
            parts = {k: [] for k in ("row", "d", "x", "y")}
            for k, (near, far, body) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 4)))):
                at = np.arange(far - near + 1)
                data = np.frombuffer(body, np.uint8)
                parts["row"].append(np.full(len(at), k))
                parts["d"].append((far - at).astype(np.int32))
                for name, poly in zip("xy", polys):
                    parts[name].append(poly.of(poly.prefix(data), at, length).view(np.int64))
            flat = {k: np.concatenate(v) for k, v in parts.items()}
            ids = {name: batch.column(c).take(pa.array(flat["row"])) for c, name in enumerate(_ID)}
            return ids | {k: flat[k] for k in ("d", "x", "y")}

        return step

    strings = materialize(arrow_map(rows.select(*_ID, "body"), make, "gram long, near int, far int, context binary, d int, x long, y long"), "strings")
    often = strings.groupBy("gram", "d", "x", "y").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    hits = strings.join(often, ["gram", "d", "x", "y"], "left_semi")
    return hits.groupBy(*_ID).agg(F.collect_list(F.struct(F.col("d").alias("a"), F.col("d").alias("b"))).alias("spans"))


def _class_spans(found: DataFrame, length: int) -> DataFrame:
    """``key, spans``: byte ranges of each class, as pairs of 32-bit numbers in order."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out = []
            for at, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                places = np.frombuffer(at, "<i4").astype(np.int64)
                out.append(np.concatenate([np.column_stack([places - s["b"], places - s["a"] + length]) for s in spans]).astype("<i4").tobytes())
            return {"key": batch.column(0), "ranges": pa.array(out, pa.binary())}

        return step

    rows = arrow_map(found.select("key", "at", "spans"), make, "key binary, ranges binary")
    return rows.groupBy("key").agg(F.collect_list("ranges").alias("ranges"))


def _cut(rows: DataFrame) -> DataFrame:
    """``key, n_removed, n_spans, kept_sha256`` from ``key, text, ranges``."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            removed, n_spans, sha = [], [], []
            for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                ranges = np.frombuffer(b"".join(parts), "<i4").reshape(-1, 2)
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, ranges[:, 0], 1)
                np.add.at(depth, ranges[:, 1], -1)
                gone = np.cumsum(depth)[:-1] > 0
                removed.append(int(gone.sum()))
                n_spans.append(len(_intervals(gone)))
                sha.append(hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
            return {"key": batch.column(0), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": sha}

        return step

    return arrow_map(rows.select("key", "text", "ranges"), make, "key binary, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 200, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    c = F.col
    # Joins are by merge at every size, so that disk grows as the input and no plan is given up for another.
    rows = materialize(anchors(docs, length, gram), "anchors")
    classes = rows.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes"), F.max("sha").alias("sha"))
    classes = materialize(classes, "classes")
    leaders = rows.filter(F.size("grams") > 0).hint("merge").join(classes.select("key", "leader"), "key").filter(c("doc_id").eqNullSafe(c("leader"))).dropDuplicates(["key"])
    met = materialize(leaders.select("key", F.explode("grams").alias("gram")), "met")
    often = met.groupBy("gram").agg(F.count("*").alias("_n")).filter("_n > 1").select("gram")
    repeated = met.hint("merge").join(often, "gram").groupBy("key").agg(F.collect_set("gram").alias("grams"))
    repeated = materialize(repeated.hint("merge").join(classes.select("key", "leader"), "key"), "repeated")
    # The texts of classes with a repeated anchor, one of each.
    ids = repeated.select("leader").distinct()
    leads = texts(docs).hint("merge").join(ids, c("doc_id").eqNullSafe(c("leader")), "left_semi")
    named = arrow_map(leads, _named, "key binary, text string")
    wanted = materialize(named.hint("merge").join(repeated.select("key", "grams"), "key").dropDuplicates(["key"]), "wanted")
    found = materialize(contexts(wanted, length, gram), "contexts")
    equal = found.groupBy(*_ID).agg(F.sum("n").alias("total"), F.min("key").alias("key"))
    equal = materialize(equal, "equal")
    several = equal.groupBy("gram").agg(F.count("*").alias("_contexts")).filter("_contexts > 1")
    one_each = materialize(found.hint("merge").join(equal.drop("total"), [*_ID, "key"]).join(several, "gram").select(*_ID, "body", "_contexts"), "mixed")
    sorted_ = sort_contexts(one_each.filter(c("_contexts") <= block), length)
    spread = spread_contexts(one_each.filter(c("_contexts") > block), length)
    partly = materialize(sorted_.union(spread), "sorted")
    whole = F.array(F.struct(c("near").alias("a"), c("far").alias("b")))
    spans = equal.filter("total > 1").select(*_ID, whole.alias("spans")).union(
        partly.hint("merge").join(equal.filter("total = 1").select(*_ID), _ID).select(*_ID, "spans")
    )
    ranges = _class_spans(found.select(*_ID, "key", "at").hint("merge").join(spans, _ID), length)
    cut = _cut(wanted.select("key", "text").hint("merge").join(ranges, "key"))
    per = classes.hint("merge").join(cut, "key", "left")
    copied = (c("copies") > 1) & (c("n_bytes") >= length)
    per = per.select(
        "key",
        F.when(copied, c("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
    return rows.select("doc_id", "n_bytes", "key").hint("merge").join(per, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _named():
    def step(batch: pa.RecordBatch) -> dict:
        return {"key": pa.array([_key(t.encode()) for t in batch.column(1).to_pylist()], pa.binary()), "text": batch.column(1)}

    return step

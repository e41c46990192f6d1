"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Texts become ids plus an end id. A document longer than the limit is cut into pieces of the limit's
length, the last one shorter; a full piece is a sequence of its own. The other pieces are packed.

All pieces of one length are alike, so rounds move *runs*: (length, first rank, count) for pieces, (gap,
first sequence, count) for open sequences. Pieces above half the limit, of which no two share a sequence,
open one each. A round sorts runs by size into ranges; in each range a sweep from the longest piece down
finds the successor of its length among the gaps, the tightest one that holds it. Where more pieces want a
gap than there are, rank decides: runs are divided into equal counts. Gaps shrink by what they got and
take part again. Pieces and gaps that found nothing in their range meet in the next round, of half as
many ranges; in the last, of one range, pieces that fit no gap open new sequences. The number of runs is
bounded by the limit, not by the documents; pieces themselves are moved once, when they get their place.

Null and empty texts have one id, the end id. Rows that repeat are packed each by itself. An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.base import TokenIds, texts
from folio.session import materialize

PIECE, GAP, PLACED = 0, 1, 2
RUNS = "kind int, size long, first long, n long, sequence long, offset long"
BROADCAST_RUNS = 500_000


def pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int) -> DataFrame:
    """``part, doc_id, piece, start, length, ids_crc32, nth``, ``nth`` counting pieces of one length in a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, seen = TaskContext.get().partitionId(), None, {}
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            encoder = encoder or TokenIds.shared(tokenizer)
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    body = ids[at : at + 4 * limit]
                    size = len(body) // 4
                    nth = seen[size] = seen.get(size, -1) + 1
                    rows.append((part, doc_id, k, at // 4, size, zlib.crc32(body), nth))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "nth"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    schema = "part int, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
    return materialize(texts(docs).mapInArrow(run, schema), "pieces")


def sweep(runs: list[tuple[int, int, int, int]], limit: int, last: bool, next_sequence: int = 0):
    """One range's round over (kind, size, first, n): placements, and the pieces and gaps left.

    From the longest piece down, each run takes the tightest gaps that hold it; a run of more pieces than
    gaps goes on to the next gap by rank, and what remains of a gap is a gap again. ``last``: no further
    round follows, so pieces that fit nowhere open sequences from ``next_sequence``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    placed, left = [], []

    def add(size: int, first: int, n: int) -> None:
        if size not in gaps:
            gaps[size] = []
            insort(sizes, size)
        gaps[size].append((first, n))

    for kind, size, first, n in sorted(runs):
        if kind == GAP:
            add(size, first, n)
    for length, rank, n in sorted(((s, f, n) for kind, s, f, n in runs if kind == PIECE), reverse=True):
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                if not last:
                    left.append((length, rank, n))
                    break
                add(limit, next_sequence, -(-n // (limit // length)))
                next_sequence += -(-n // (limit // length))
                continue
            size = sizes[at]
            first, count = gaps[size].pop()
            if not gaps[size]:
                del gaps[size], sizes[at]
            k = min(n, count)
            placed.append((length, rank, k, first, limit - size))
            if count > k:
                add(size, first + k, count - k)
            if size > length:
                add(size - length, first, k)
            rank, n = rank + k, n - k
    return placed, left, [(s, f, n) for s in sizes for f, n in gaps[s]]


def _round(state: DataFrame, limit: int, ranges: int, next_sequence: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        runs = pd.concat(parts)
        free = runs[runs.kind != PLACED]
        todo = [tuple(map(int, x)) for x in free[["kind", "size", "first", "n"]].itertuples(index=False)]
        placed, left, gaps = sweep(todo, limit, ranges == 1, next_sequence)
        rows = [(PLACED, s, r, n, q, o) for s, r, n, q, o in placed]
        if ranges > 1:
            rows += [(PIECE, s, f, n, 0, 0) for s, f, n in left] + [(GAP, s, f, n, 0, 0) for s, f, n in gaps]
        yield pd.DataFrame(rows, columns=["kind", "size", "first", "n", "sequence", "offset"])

    free = state.filter(F.col("kind") != PLACED)
    dealt = free.repartitionByRange(ranges, "size") if ranges > 1 else free.coalesce(1)
    return dealt.mapInPandas(run, RUNS)


def placements(spark: SparkSession, lengths: DataFrame, limit: int, ranges: int = 8) -> DataFrame:
    """Runs of kind ``PLACED`` for the histogram ``lengths`` (``length, n``, lengths below the limit)."""
    need = lengths.agg(F.sum(F.when(F.col("length") * 2 > limit, F.col("n")))).first()[0] or 0
    longest = Window.orderBy(F.col("length").desc())
    runs = lengths.withColumn("_before", F.sum("n").over(longest) - F.col("n"))
    runs = runs.withColumn("_open", F.when(F.col("length") * 2 > limit, F.col("n")).otherwise(F.lit(0)).cast("long"))
    row = lambda kind, size, first, n, sequence: [F.lit(kind).alias("kind"), size.alias("size"), first.alias("first"), n.alias("n"), sequence.alias("sequence"), F.lit(0).cast("long").alias("offset")]
    zero, c = F.lit(0).cast("long"), F.col
    started = runs.filter("_open > 0")
    state = (
        runs.filter("n > _open").select(*row(PIECE, c("length"), c("_open"), c("n") - c("_open"), zero))
        .union(started.select(*row(GAP, F.lit(limit) - c("length"), c("_before"), c("_open"), zero)))
        .union(started.select(*row(PLACED, c("length"), zero, c("_open"), c("_before"))))
    )
    state = materialize(state, "runs")
    done = [state.filter(c("kind") == PLACED)]
    while ranges >= 1:
        state = materialize(_round(state, limit, ranges, need), "runs")
        done.append(state.filter(c("kind") == PLACED))
        ranges //= 2
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def pack(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, limit, end_id)
    here = cut.groupBy("part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    here = materialize(here.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ranks")
    lengths = here.filter(F.col("length") < limit).groupBy("length").agg(F.sum("_n").alias("n"))
    runs = materialize(placements(spark, lengths, limit), "placed")
    used, size = runs.agg(F.max(F.col("sequence") + F.col("n")), F.count("*")).first()
    runs = runs.select(F.col("size").alias("length"), F.col("first").alias("_first"), (F.col("first") + F.col("n")).alias("_last"), F.col("sequence"), F.col("offset"))
    ranked = cut.join(here.select("part", "length", "_base"), ["part", "length"]).withColumn("_rank", F.col("_base") + F.col("nth"))
    full = ranked.filter(F.col("length") == limit)
    rest = ranked.filter(F.col("length") < limit)
    if size <= BROADCAST_RUNS:
        runs = F.broadcast(runs)
    inside = (rest["length"] == runs["length"]) & (rest["_rank"] >= runs["_first"]) & (rest["_rank"] < runs["_last"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    fitted = rest.join(runs, inside).select(*[rest[k] for k in columns], (F.col("sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"), "offset")
    return full.select(*columns, (F.lit(used or 0) + F.col("_rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).union(fitted)

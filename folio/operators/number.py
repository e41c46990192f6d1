"""Row numbers and running totals without a single-task step over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these bits


def number_rows(df: DataFrame, out: str = "ord") -> DataFrame:
    """Add consecutive numbers from 0 in the order of the input.

    The partition and the place in it are written with the rows, so both reads of the table agree
    whatever happens to the executors; the number is the place plus the sizes of the partitions
    before it. That side has one row per input partition.
    """
    placed = materialize(df.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _ROW_BITS).cast("int")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_part", "_start", "_place")
    )


def number_in_groups(df: DataFrame, group: list[str], order: list[str], out: str = "n_before", size: str = "n_group") -> DataFrame:
    """Add each row's number from 0 in its group, by ``order``, and the rows of the group.

    Rows are sorted over all tasks by group and order, so a group of any size is spread. What counts the rows before a
    range has one row for each group and range, and rows meet it by range, never by group alone. Rows equal in
    ``order`` are numbered in any order; null keys make a group of their own.
    """
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", _ROW_BITS)
    pieces = placed.groupBy(part.alias("_part"), *group).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "*", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias(size)
    )
    same = F.shiftright("r._place", _ROW_BITS) == F.col("p._part")
    for name in group:
        same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"p.{name}"))
    number = F.col("r._place") - F.col("p._first") + F.col("p._before")
    return placed.alias("r").join(pieces.alias("p"), same).select(*[f"r.{c}" for c in df.columns], number.alias(out), F.col(f"p.{size}"))


def running_totals(df: DataFrame, key: str, values: list[str], chunk: int = 10_000) -> DataFrame:
    """Running sums of ``values`` by ascending whole-number ``key`` (unique, not negative).

    Sums run inside chunks of the key in parallel; only one row per chunk is summed in sequence.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(key) / chunk))
    within = Window.partitionBy("_chunk").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy("_chunk").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    starts = totals.select(
        "_chunk", *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_start_{v}") for v in values]
    )
    return (
        chunked.select("*", *[F.sum(v).over(within).alias(f"_run_{v}") for v in values])
        .join(starts, "_chunk")
        .select(
            *[c for c in df.columns if c not in values],
            *[(F.col(f"_run_{v}") + F.col(f"_start_{v}")).alias(v) for v in values],
        )
    )

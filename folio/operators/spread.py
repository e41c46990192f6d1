"""Equi-joins whose left side may hold one key in a large share of its rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 1_000_000  # smaller left sides are joined as they are
SAMPLE_ROWS = 1_000_000
LANES = 1024  # a key with share s of the left rows is split over about s * LANES tasks


def _hot_keys(left: DataFrame, keys: list[str], total: int, lanes: int) -> list[tuple]:
    """Keys owning at least 2 / lanes of the rows, with their lane counts: at most lanes / 2 keys.

    Read from a sample; a miss costs balance, never rows.
    """
    share = min(1.0, SAMPLE_ROWS / total)
    present = left.select(*keys).dropna()
    sampled = present if share == 1.0 else present.sample(share, seed=1)
    expected = total * share
    hot = (
        sampled.groupBy(*keys)
        .count()
        .where(F.col("count") * lanes >= 2 * expected)
        .select(*keys, F.ceil(F.col("count") * lanes / expected).cast("int").alias("_lanes"))
    )
    return [tuple(row) for row in hot.orderBy(F.desc("_lanes")).limit(lanes).collect()]


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, tasks: int | None) -> DataFrame:
    if tasks:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.join(right, keys, how)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    small_rows: int = SMALL_ROWS,
    lanes: int = LANES,
    tasks: int | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` that splits hot keys of ``left`` over many tasks.

    With ``tasks`` both sides are laid out over that many partitions, by the join's own keys: the
    one shuffle each side needs anyway, sized for what is done with the result.

    Rows of a hot key get a lane each and the matching right rows are repeated once per lane, so
    the result is the plain join's. ``right`` is expected to have few rows per key. The left side
    is read up to three times: pass a table or a materialized frame.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"cannot spread a {how} join")
    total = left.count()
    if total <= small_rows:
        return _join(left, right, keys, how, tasks)
    others = [F.col(c) for c in left.columns if c not in keys] or [F.monotonically_increasing_id()]
    missing: Column = reduce(or_, [F.col(k).isNull() for k in keys])
    hot = _hot_keys(left, keys, total, lanes)
    scatter = F.xxhash64(*others)
    if hot:
        key_types = [left.schema[k] for k in keys]
        spark = left.sparkSession
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_types) + ", _lanes int"
        # Bounded by ``lanes``: the sample cannot hold more keys of that share.
        table = F.broadcast(spark.createDataFrame(hot, schema))
        left = left.join(table, keys, "left")
        right = right.join(table, keys, "left")
        lane_count = F.coalesce(F.col("_lanes"), F.lit(1))
        right = right.withColumn("_lane", F.explode(F.sequence(F.lit(0), lane_count - 1))).drop("_lanes")
    else:
        lane_count = F.lit(1)
        right = right.withColumn("_lane", F.lit(0))
    # Rows without a key match nothing; scatter them too.
    lane = F.pmod(scatter, F.when(missing, F.lit(lanes)).otherwise(lane_count)).cast("int")
    left = left.withColumn("_lane", lane).drop("_lanes")
    return _join(left, right, [*keys, "_lane"], how, tasks).drop("_lane")

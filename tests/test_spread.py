import pytest
from pyspark.sql import functions as F

from folio.operators.spread import _hot_keys, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    # A third of the rows hold one key, a sixth hold none.
    left = spark.range(6000).selectExpr(
        "id AS ord", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 6 = 1 THEN NULL ELSE concat('k', id % 700) END AS key"
    )
    right = spark.range(500).selectExpr("concat('k', id) AS key", "id AS v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "key string, v bigint")
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_same_as_plain_join(sides, how):
    left, right = sides
    spread = spread_join(left, right, ["key"], how, small_rows=0)
    plain = left.join(right, ["key"], how)
    assert sorted(spread.columns) == sorted(plain.columns)
    columns = sorted(plain.columns)
    assert sorted(map(repr, spread.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect()))


def test_without_hot_keys(sides):
    left, right = sides
    cold = left.where("key LIKE 'k%'")
    assert spread_join(cold, right, ["key"], small_rows=0).count() == cold.join(right, "key").count()


def test_right_side_may_repeat_a_key(sides):
    left, right = sides
    twice = right.unionByName(right)
    assert spread_join(left, twice, ["key"], small_rows=0).count() == left.join(twice, "key").count()


def test_hot_keys_are_found_and_few(sides):
    left, _ = sides
    hot = _hot_keys(left, ["key"], left.count(), 64)
    assert [key for key, _ in hot][0] == "hot"
    assert len(hot) <= 32
    # Their lanes hold about a 64th of the rows each.
    assert 20 <= hot[0][1] <= 30


def test_hot_rows_reach_many_partitions(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        joined = spread_join(left, right, ["key"], small_rows=0, lanes=64).where("key = 'hot'")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = left.join(right, "key").where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(plain) == 1 and len(sizes) > 4 and max(sizes) < 2000 / 2

import random

from pyspark.sql import functions as F

from folio.operators.number import number_in_groups, number_rows, running_totals


def test_numbers_follow_input_order(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("id * 3 AS v")
    rows = number_rows(df.where("v % 2 = 0"), "ord").orderBy("ord").collect()
    assert [row.ord for row in rows] == list(range(len(rows)))
    assert [row.v for row in rows] == sorted(row.v for row in rows)


def test_empty(spark):
    assert number_rows(spark.range(0)).count() == 0


def test_running_totals(spark):
    random.seed(3)
    keys = sorted(random.sample(range(500), 120))
    rows = [(key, random.randrange(9), random.randrange(9)) for key in keys]
    df = spark.createDataFrame(rows, "k bigint, a bigint, b bigint").withColumn("kept", F.col("k") * 10)
    got = sorted((r.k, r.kept, r.a, r.b) for r in running_totals(df, "k", ["a", "b"], chunk=16).collect())
    a = b = 0
    want = []
    for key, one, two in rows:
        a, b = a + one, b + two
        want.append((key, key * 10, a, b))
    assert got == want


def test_numbers_in_groups(spark):
    random.seed(5)
    rows = [(random.choice(["hot", "hot", "hot", None, "a", "b"]), random.randrange(40)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(5)
    got = number_in_groups(df, ["g"], ["v"], "k", "size").collect()
    assert sorted((r.g or "", r.v) for r in got) == sorted((g or "", v) for g, v in rows)
    for group in ("hot", None, "a", "b"):
        mine = sorted((r.k, r.v) for r in got if r.g == group)
        assert [k for k, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for g, v in rows if g == group)
        assert {r["size"] for r in got if r.g == group} == {len(mine)}

"""The filter ahead of joins: never a wrong no, few wrong yeses, and no shuffle of what is certainly new."""

from compare import plan
from pyspark.sql import functions as F

from folio.operators import sift as sift_module
from folio.operators.collect import resume_todo
from folio.operators.sift import anti_join, mark_members, sift


def ids(spark, begin, end):
    return spark.range(begin, end).selectExpr("CAST(id AS STRING) AS id", "id * 2 AS other")


def test_members_are_marked(spark):
    rows = mark_members(ids(spark, 0, 5000), ids(spark, 4000, 9000), ["id"]).collect()
    assert all(row.maybe for row in rows if int(row.id) >= 4000)
    assert sum(row.maybe for row in rows if int(row.id) < 4000) < 10


def test_a_full_filter_lets_all_through(spark, monkeypatch):
    monkeypatch.setattr(sift_module, "BITS", 16)
    rows, wanted = ids(spark, 0, 2000), ids(spark, 1000, 300_000)
    assert sift(rows, wanted, ["id", "other"]).count() > 1900
    assert sift(rows, wanted.limit(0), ["id"]).count() == 0


def test_books_without_a_cover(spark, monkeypatch):
    for bits in (27, 15):
        monkeypatch.setattr(sift_module, "BITS", bits)
        books = ids(spark, 0, 3000).union(spark.sql("SELECT CAST(NULL AS STRING), 1")).union(ids(spark, 10, 12))
        got = resume_todo(books, ids(spark, 1000, 50_000).union(ids(spark, 5, 20))).collect()
        want = [None] + [str(k) for k in range(1000) if not 5 <= k < 20]
        assert sorted(row.id or "" for row in got) == sorted(x or "" for x in want)


def test_new_ids_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        books, known = ids(spark, 0, 3000), ids(spark, 2000, 9000)
        text = plan(anti_join(books, known, ["id"], lambda left, right: left.join(right, "id", "left_anti")))
        certain = plan(mark_members(books, sift(known.select("id"), books, ["id"]), ["id"], "_maybe").where("NOT _maybe"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
    assert "hashpartitioning(id" in text  # the exact join, of what may match
    assert "hashpartitioning(id" not in certain and "BroadcastHashJoin" in certain


def test_null_and_extra_columns(spark):
    rows = spark.sql("SELECT CAST(NULL AS STRING) AS id, 1 AS k UNION ALL SELECT 'a', 2").withColumn("bits", F.lit(0))
    assert [row.k for row in sift(rows, rows.limit(0), ["id"]).collect()] == []
    assert sift(rows, rows, ["id"]).columns == ["id", "k", "bits"]

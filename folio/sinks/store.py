"""Curated table and covers table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.sift import sift
from folio.operators.spread import spread_join

BUCKETS = 16
TASK_BYTES = 1 << 30


def write_curated(books: DataFrame, path: str) -> None:
    books.write.mode("overwrite").parquet(path)


def bucket_of(book_id: Column, buckets: int = BUCKETS) -> Column:
    """The store folder of an id; keep ``buckets`` the same for the life of a store."""
    return F.pmod(F.xxhash64(book_id), F.lit(buckets)).cast("int")


def covers_with_content(covers: DataFrame, bodies: DataFrame, tasks: int | None = None) -> DataFrame:
    """``id, img_url, width, height, length, content``: the accepted bytes of each id.

    ``covers`` is narrow and names the place of the one record of the log whose bytes are stored. A filter over these
    places keeps all other bodies where they are, so what is shuffled is what is stored, however often a
    response was recorded.
    """
    keys = ["img_url", "attempt", "file", "row"]
    narrow = covers.select("id", *keys, "width", "height", "length")
    matched = spread_join(narrow, sift(bodies, narrow, ["file", "row"]), keys, tasks=tasks)
    return matched.select("id", "img_url", "width", "height", "length", "content")


def write_covers(covers: DataFrame, bodies: DataFrame, store: str, buckets: int = BUCKETS, task_bytes: int = TASK_BYTES) -> None:
    """Append covers with their bytes to the store, one row per id.

    The bytes are shuffled once, by the join that finds them, into tasks of about ``task_bytes``; each task writes a
    file a bucket.
    """
    total = covers.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    rows = covers_with_content(covers, bodies, tasks=max(1, -(-total // task_bytes)))
    rows.withColumn("bucket", bucket_of(F.col("id"), buckets)).write.mode("append").partitionBy("bucket").parquet(store)

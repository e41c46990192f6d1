"""Stored page and image responses."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.charset import with_text
from folio.functions.html import with_cover_url
from folio.functions.images import with_image_size
from folio.operators.collect import OK_STATUS
from folio.session import materialize


def page_attempts(fetch_log: DataFrame, mode: str = "auto") -> DataFrame:
    """``url, attempt, status, img_url`` of the page responses; only OK bodies are searched, as text of their charset."""
    charset = F.col("charset") if "charset" in fetch_log.columns else F.lit(None).cast("string")
    pages = fetch_log.where(F.col("kind") == "page").select(
        "url", "attempt", "status", F.when(F.col("status") == OK_STATUS, F.col("body")).alias("body"), charset.alias("charset")
    )
    return with_cover_url(with_text(pages, "body", "charset", "html", any_charset=mode != "native"), mode=mode)


def in_files(fetch_log: DataFrame) -> DataFrame:
    """The log itself when it is read from files, else a copy in files: each record then has a place."""
    try:
        fetch_log.select("_metadata.row_index")
    except AnalysisException:
        return materialize(fetch_log, "log")
    return fetch_log


def record_place() -> list[Column]:
    """``file, row``: where a log in files has the record. The file is told by a hash of its name."""
    return [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def image_attempts(fetch_log: DataFrame) -> DataFrame:
    """``img_url, attempt, status, length, digest, file, row, width, height`` of the image responses of a log in files.

    Digest and place stand for the bytes, which stay in the log.
    """
    images = fetch_log.where(F.col("kind") == "image").select(
        F.col("url").alias("img_url"),
        F.col("attempt").cast("int").alias("attempt"),
        "status",
        *record_place(),
        F.when(F.col("status") == OK_STATUS, F.col("body")).alias("content"),
    )
    body = F.col("content")
    described = images.select(
        "img_url",
        "attempt",
        "status",
        F.length(body).cast("bigint").alias("length"),
        F.xxhash64(body).alias("digest"),
        "file",
        "row",
        body,
    )
    return with_image_size(described).drop("format")


def image_bodies(fetch_log: DataFrame) -> DataFrame:
    """``img_url, attempt, file, row, content`` of the image responses that came back OK, of a log in files."""
    return fetch_log.where((F.col("kind") == "image") & (F.col("status") == OK_STATUS)).select(
        F.col("url").alias("img_url"), F.col("attempt").cast("int").alias("attempt"), *record_place(), F.col("body").alias("content")
    )

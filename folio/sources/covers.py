"""Covers kept as loose files or as a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.schemas import COVERS

_ID_IN_PATH = r"([^/]+)\.jpg$"


def scan_cover_files(spark: SparkSession, directory: str) -> DataFrame:
    """``id, path, length, content`` of the ``.jpg`` files of a folder, whatever format they hold."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(directory)
    return files.select(F.regexp_extract("path", _ID_IN_PATH, 1).alias("id"), "path", "length", "content")


def existing_ids(spark: SparkSession, store: str) -> DataFrame:
    """Ids in the covers table at ``store``; none when it has not been written yet."""
    try:
        covers = spark.read.schema(COVERS).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        covers = spark.createDataFrame([], COVERS)
    return covers.select("id").distinct()

"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, secret scans, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table. All but the last return the columns of
``docs``; each result is written as Parquet and read again as the next stage's ``docs``.

Rows are decided on one by one. A document rejected by the quality rules goes; of near duplicates (five-word
shingles, similarity 0.8 or more) the one with the least id stays, and among equal ids that with the least hash of its
text; of rows with the same id and text one stays, a null text being an empty one. A document that holds a
benchmark item goes; secrets are replaced by their kind. Null texts are empty ones and fail the quality rules.
Empty tables pass through; further columns are kept with their values up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.base import table
from folio.llm.decontaminate import clean
from folio.llm.jaccard import jaccard_groups, row_mark
from folio.llm.packing import pack
from folio.llm.perplexity import quality_rules
from folio.llm.queries import vocabulary
from folio.llm.secrets import redact
from folio.session import bound_batches, drop_tables, noting, work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables the result of the stage before is read from; they go once that result has been written.
_BEHIND: list[str] = []


def stage(make: Stage) -> Stage:
    """A stage that deletes what the one before has left, unless its own input still reads it; batches are bounded."""

    @wraps(make)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        read = docs.inputFiles()
        done = [path for path in _BEHIND if not any(path in file for file in read)]
        drop_tables(spark, done)
        with noting() as written:
            out = make(spark, docs, sf_dir)
        _BEHIND[:] = [path for path in _BEHIND if path not in done] + written
        return out

    return run


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules(docs, whole=True).filter("kept").select("_docs.*")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "mark")
    groups = jaccard_groups(docs.withColumn("doc_id", F.col("doc_id").cast("long")), size=5, percent=80)
    first = groups.groupBy("group").agg(F.min(order).alias("_first")).select(F.col("_first.doc_id").alias("_id"), F.col("_first.mark").alias("_mark"))
    here = docs.select(F.struct("*").alias("_docs"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    here = here.select("_docs", "doc_id", row_mark().alias("mark"))
    kept = here.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi")
    return kept.dropDuplicates(["doc_id", "mark"]).select("_docs.*")  # of rows with the same id and text, one


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary(), limit=2048, end_id=0)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("packing", packing),
]

#: No SQL expresses the perplexity model or the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The book catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.sample import SEED, maybe_sample
from folio.schemas import require_columns
from folio.sources.records import Records, read_csv, read_json

REQUIRED = ("id", "url", "genres", "num_ratings", "num_reviews")
#: Types of the needed columns in JSON; a list of genres is read as its JSON text.
NAMED = {"id": "string", "url": "string", "genres": "string", "num_ratings": "double", "num_reviews": "double"}
CSV_DIALECT = {"header": "true", "escape": '"'}


def conform(books: DataFrame) -> DataFrame:
    """Check the needed columns and settle their types; further columns pass through."""
    require_columns(books, *REQUIRED)
    types = {field.name: field.dataType for field in books.schema.fields}
    settled = {"id": F.col("id").cast("string")} if types["id"] != T.StringType() else {}
    for name in ("num_ratings", "num_reviews"):
        if isinstance(types[name], T.StringType):
            settled[name] = F.col(name).cast("double")
    return books.withColumns(settled) if settled else books


def read_books(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    split: str | None = None,
    schema: dict[str, str] | None = None,
    **options: str,
) -> tuple[DataFrame, Records | None]:
    """A catalogue in Parquet, JSON lines or CSV, and for the latter two what its files hold beside books.

    ``split`` names a folder below ``path``. JSON's further columns are those of ``schema``, types by name, if given.
    With ``options`` of another dialect than a header and doubled quotes, CSV is left to Spark's reader.
    """
    if split:
        path = f"{path.rstrip('/')}/{split}"
    if fmt == "json" and not options:
        records = read_json(spark, path, NAMED, schema)
    elif fmt == "csv" and options.items() <= CSV_DIALECT.items():
        records = read_csv(spark, path)
    else:
        if fmt == "csv":
            options = {**CSV_DIALECT, "multiLine": "true", **options}
        return conform(spark.read.format(fmt).options(**options).load(path)), None
    return conform(records.rows), records


def load_books(
    spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None, schema: dict[str, str] | None = None, **options: str
) -> DataFrame:
    """The books of a catalogue; what is no book is left out, see ``read_books``."""
    return read_books(spark, path, fmt, split, schema, **options)[0]


def load_catalog(
    spark: SparkSession, path: str, sample_size: int | None = None, seed: int = SEED, strict: bool = True
) -> DataFrame:
    """Read the curated table, whole or as an exact-size sample."""
    return maybe_sample(spark.read.parquet(path), sample_size, seed, strict)

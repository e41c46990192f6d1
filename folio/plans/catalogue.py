"""Catalogue curation and the genre profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from folio.operators.curate import MIN_RATINGS, curate_observed
from folio.operators.genres import (
    MIN_COUNT,
    TOP_GENRES,
    genre_counts,
    genre_distinct,
    genre_frequent,
    genre_parse_report,
    genre_top,
)
from folio.session import materialize
from folio.sinks.store import write_curated
from folio.sources.catalog import read_books


@dataclass
class GenreProfile:
    counts: DataFrame
    top: DataFrame
    frequent: DataFrame
    distinct: DataFrame
    parsed: DataFrame  # how many genre texts were read, and how many are malformed and counted for nothing


@dataclass
class Curated:
    books: DataFrame
    funnel: dict[str, int]  # books before and after each filter
    n_bad: int = 0  # records of the raw files that are no books


def curate_to(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    min_ratings: int = MIN_RATINGS,
    quarantine: str | None = None,
    **options,
) -> Curated:
    """Read a catalogue, write the curated books, and go on from the written table.

    Records that are no books are counted in the same pass and, if there are any, written to ``quarantine`` (``file,
    record``).
    """
    raw, records = read_books(spark, source, fmt, **options)
    books, funnel = curate_observed(raw, min_ratings)
    write_curated(books, target)
    n_bad = records.seen.get["n_bad"] if records else 0
    if n_bad and quarantine:
        records.bad.write.mode("overwrite").parquet(quarantine)
    return Curated(spark.read.parquet(target), funnel.get, n_bad)


def genre_profile(books: DataFrame, top: int = TOP_GENRES, min_count: int = MIN_COUNT, fail: bool = False) -> GenreProfile:
    """Histogram of the genres, counted once, and the reports drawn from it.

    Malformed genre texts are left out of the histogram and counted in ``parsed``; with ``fail`` they are an error.
    """
    counts = materialize(genre_counts(books, fail), "genres")
    distinct, parsed = genre_distinct(counts), genre_parse_report(books)
    return GenreProfile(counts, genre_top(counts, top), genre_frequent(counts, min_count), distinct, parsed)

"""Catalogue filters and the row-count funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folio.schemas import is_array, is_floating, require_columns

# Fixed value: a book is popular above this many ratings.
MIN_RATINGS = 7500


def _present(df: DataFrame, name: str) -> Column:
    """Neither null nor NaN."""
    value = F.col(name)
    return value.isNotNull() & ~F.isnan(value) if is_floating(df, name) else value.isNotNull()


def has_genres(df: DataFrame) -> Column:
    genres = F.col("genres")
    return genres.isNotNull() & ((F.size(genres) > 0) if is_array(df, "genres") else (genres != "[]"))


def has_counts(df: DataFrame) -> Column:
    return _present(df, "num_ratings") & _present(df, "num_reviews")


def is_popular(df: DataFrame, min_ratings: int = MIN_RATINGS) -> Column:
    return _present(df, "num_ratings") & (F.col("num_ratings") > min_ratings)


def books_with_genres(books: DataFrame) -> DataFrame:
    return books.where(has_genres(require_columns(books, "genres")))


def books_with_counts(books: DataFrame) -> DataFrame:
    return books.where(has_counts(require_columns(books, "num_ratings", "num_reviews")))


def books_popular(books: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    return books.where(is_popular(require_columns(books, "num_ratings"), min_ratings))


def curate(books: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Books with genres, with counts, and popular; all columns kept."""
    return books_popular(books_with_counts(books_with_genres(books)), min_ratings)


def _funnel(books: DataFrame, min_ratings: int) -> list[Column]:
    genres, counts, popular = has_genres(books), has_counts(books), is_popular(books, min_ratings)
    return [
        F.count("*").alias("n_books"),
        F.count_if(genres).alias("n_with_genres"),
        F.count_if(genres & counts).alias("n_with_counts"),
        F.count_if(genres & counts & popular).alias("n_popular"),
    ]


def curation_funnel(books: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """One row: books before and after each filter, from a single pass."""
    require_columns(books, "genres", "num_ratings", "num_reviews")
    return books.agg(*_funnel(books, min_ratings))


def curate_observed(books: DataFrame, min_ratings: int = MIN_RATINGS) -> tuple[DataFrame, Observation]:
    """Curated books, and the funnel as seen by the first job that reads them: no pass of its own."""
    require_columns(books, "genres", "num_ratings", "num_reviews")
    seen = Observation("funnel")
    return curate(books.observe(seen, *_funnel(books, min_ratings)), min_ratings), seen

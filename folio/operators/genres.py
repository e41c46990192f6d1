"""Genre lists, histogram and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.genres import is_plain_list, parse_genres, read_odd_list, split_plain_list
from folio.schemas import is_array, require_columns

# A genre is frequent above this count; the report shows this many genres.
MIN_COUNT = 2000
TOP_GENRES = 29

#: Registers of a distinct-count sketch, as a power of two.
SKETCH_LG_K = 12


def with_genre_list(books: DataFrame, out: str = "genre_list", fail: bool = False) -> DataFrame:
    """Add the genres as an array; null for malformed text, or an error with ``fail``."""
    require_columns(books, "genres")
    genres = F.col("genres")
    return books.withColumn(out, genres if is_array(books, "genres") else parse_genres(genres, fail))


def genre_explode(books: DataFrame, *keep: str, fail: bool = False) -> DataFrame:
    """One row per book and listed genre; books without genres give none."""
    listed = with_genre_list(books, "genre_list", fail)
    # The outer form, which reads each list once; the rows it adds for books without genres have no place.
    rows = listed.select(*keep, F.posexplode_outer("genre_list").alias("_place", "genre"))
    return rows.where(F.col("_place").isNotNull()).drop("_place")


def genre_parse_report(books: DataFrame) -> DataFrame:
    """One row: texts read by pattern, texts read as literals, and malformed texts."""
    texts = require_columns(books, "genres").where(F.col("genres").isNotNull())
    plain = is_plain_list(F.col("genres"))
    # Equal odd texts are read once, after they have been counted.
    counted = texts.groupBy(F.when(~plain, F.col("genres")).alias("odd")).agg(F.count("*").alias("n"))
    read = counted.withColumn("items", read_odd_list(F.col("odd")))

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    odd, items = F.col("odd"), F.col("items")
    return read.agg(
        total(odd.isNull()).alias("n_plain"),
        total(odd.isNotNull() & items.isNotNull()).alias("n_literal"),
        total(odd.isNotNull() & items.isNull()).alias("n_malformed"),
    )


def genre_counts(books: DataFrame, fail: bool = False) -> DataFrame:
    """``(genre, count)``: how often each genre is listed; repeats within a book count.

    Plain lists are split and counted in the JVM. Other texts travel whole through the same
    aggregation, so that Python reads each distinct one once, from the small counted table.
    """
    require_columns(books, "genres")
    if is_array(books, "genres"):
        items = books.select(F.explode("genres").alias("genre"))
        return items.groupBy("genre").agg(F.count("*").alias("count"))
    genres = F.col("genres")
    is_item = F.col("plain")
    counted = (
        books.where(genres.isNotNull())
        .select(genres, is_plain_list(genres).alias("plain"))
        .select("plain", F.when(is_item, split_plain_list(genres)).otherwise(F.array(genres)).alias("items"))
        # The outer form, since the inner one would evaluate the items a second time to drop empty
        # lists ahead of it; items are never null here.
        .select("plain", F.explode_outer("items").alias("item"))
        .where(F.col("item").isNotNull())
        .groupBy("plain", "item")
        .agg(F.count("*").alias("n"))
    )
    item = F.col("item")
    items = F.when(is_item, F.array(item)).otherwise(read_odd_list(F.when(~is_item, item), fail))
    return (
        counted.select(F.explode(items).alias("genre"), "n")
        .groupBy("genre")
        .agg(F.sum("n").alias("count"))
    )


def genre_ranked(counts: DataFrame) -> DataFrame:
    """Most frequent first; equal counts by name."""
    return counts.orderBy(F.desc("count"), F.asc("genre"))


def genre_top(counts: DataFrame, top: int = TOP_GENRES) -> DataFrame:
    return genre_ranked(counts).limit(top)


def genre_distinct(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("n_genres"))


def genre_frequent(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return counts.where(F.col("count") > min_count)


def genre_frequent_count(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return genre_frequent(counts, min_count).agg(F.count("*").alias("n_frequent"))


def genre_sketches(books: DataFrame, *by: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A sketch of the distinct genres for each value of ``by``, a few kilobytes each, to be kept with the catalogue."""
    listed = genre_explode(books, *by).where(F.col("genre").isNotNull())
    return listed.groupBy(*by).agg(F.hll_sketch_agg("genre", F.lit(lg_k)).alias("sketch"))


def genre_distinct_approx(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many distinct genres the parts of each ``by`` have together, from their sketches alone.

    The relative standard error is about ``0.83 / sqrt(2 ** lg_k)``, 1.3 % as set; a few hundred genres are counted exactly.
    """
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("_all"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("_all"), F.lit(0)).cast("bigint").alias("n_genres"))

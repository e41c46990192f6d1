"""The queries the engine answers, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import fixtures
from folio.functions.html import with_cover_url
from folio.functions.images import aspect_ratio, is_valid_geometry, sniff_format, with_image_size
from folio.functions.urls import is_usable_url
from folio.operators import collect, curate, genres
from folio.operators.number import number_rows
from folio.operators.sample import NOTEBOOK_SAMPLE, RUN_SAMPLE, sample_exact
from folio.plans.catalogue import curate_to, genre_profile
from folio.plans.covers import collect_covers, read_responses, store_covers
from folio.session import materialize, work_path
from folio.sinks.files import existing_ids_in_files, export_cover_files
from folio.sinks.store import write_curated
from folio.sources.catalog import load_books, load_catalog
from folio.sources.covers import existing_ids, scan_cover_files
from folio.sources.responses import page_attempts

Query = Callable[[SparkSession, str], DataFrame]


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate(fixtures.books(spark, sf_dir))


def _genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres.genre_counts(_curated(spark, sf_dir))


# --- catalogue


def books_with_genres(spark, sf_dir):
    return curate.books_with_genres(fixtures.books(spark, sf_dir))


def books_with_counts(spark, sf_dir):
    return curate.books_with_counts(fixtures.books(spark, sf_dir))


def books_popular(spark, sf_dir):
    return curate.books_popular(fixtures.books(spark, sf_dir))


def curate_books(spark, sf_dir):
    return _curated(spark, sf_dir)


def curation_funnel(spark, sf_dir):
    return curate.curation_funnel(fixtures.books(spark, sf_dir))


def curated_roundtrip(spark, sf_dir):
    path = work_path(spark, "curated")
    write_curated(_curated(spark, sf_dir), path)
    return spark.read.parquet(path)


def load_catalog_whole(spark, sf_dir):
    """From raw catalogue files to the curated table, read back without sampling."""
    source, target = work_path(spark, "catalogue"), work_path(spark, "curated")
    fixtures.books(spark, sf_dir).write.parquet(f"{source}/train")
    curate_to(spark, source, target, split="train")
    return load_catalog(spark, target)


def _catalogue_in(fmt: str, **options: str) -> Query:
    def run(spark, sf_dir):
        path = work_path(spark, fmt)
        fixtures.books(spark, sf_dir).write.options(**options).format(fmt).save(path)
        books = curate.curate(load_books(spark, path, fmt))
        return books.select(
            "id",
            "url",
            "genres",
            F.col("num_ratings").cast("bigint").alias("num_ratings"),
            F.col("num_reviews").cast("bigint").alias("num_reviews"),
        )

    return run


def sample_1000(spark, sf_dir):
    return sample_exact(_curated(spark, sf_dir), NOTEBOOK_SAMPLE)


def sample_2000(spark, sf_dir):
    path = work_path(spark, "curated")
    write_curated(_curated(spark, sf_dir), path)
    return load_catalog(spark, path, RUN_SAMPLE, strict=False)


def sample_shared_ids(spark, sf_dir):
    """A sample of rows of which many share an id, and some all their values."""
    shared = fixtures.books(spark, sf_dir).selectExpr(
        "CAST(CAST(id AS BIGINT) DIV 1000 AS STRING) AS id", "num_reviews % 10 AS num_reviews"
    )
    return sample_exact(shared, 1500)


def sample_input(spark, sf_dir):
    """The sampled books in run order, numbered, with the file each cover would get."""
    return collect.scrape_input(number_rows(sample_2000(spark, sf_dir)))


# --- genres


def genre_lists(spark, sf_dir):
    listed = genres.with_genre_list(_curated(spark, sf_dir))
    return listed.select(
        "id",
        F.size("genre_list").cast("bigint").alias("n_genres"),
        F.concat_ws("|", "genre_list").alias("genre_text"),
    )


def genre_parse_report(spark, sf_dir):
    return genres.genre_parse_report(fixtures.books(spark, sf_dir))


def genre_explode(spark, sf_dir):
    return genres.genre_explode(_curated(spark, sf_dir), "id")


def genre_counts(spark, sf_dir):
    return _genre_counts(spark, sf_dir)


def genre_literals(spark, sf_dir):
    """Lists that only the literal reader can take, book by book."""
    return genres.genre_explode(fixtures.odd_genres(spark, sf_dir), "id")


def genre_literals_report(spark, sf_dir):
    return genres.genre_parse_report(fixtures.odd_genres(spark, sf_dir))


def genre_literals_frequent(spark, sf_dir):
    """Genres of such lists above a count that small tables reach."""
    return genres.genre_frequent(genres.genre_counts(fixtures.odd_genres(spark, sf_dir)), 2)


def genre_literals_frequent_count(spark, sf_dir):
    return genres.genre_frequent_count(genres.genre_counts(fixtures.odd_genres(spark, sf_dir)), 2)


def genre_distinct(spark, sf_dir):
    return genres.genre_distinct(_genre_counts(spark, sf_dir))


def genre_distinct_approx(spark, sf_dir):
    """Distinct genres of each tenth of the catalogue, and of all of it, from one stored sketch a hundredth."""
    path = work_path(spark, "sketches")
    books = _curated(spark, sf_dir).withColumn("part", F.col("num_reviews") % 100)
    genres.genre_sketches(books, "part").write.parquet(path)
    sketches = spark.read.parquet(path).withColumn("tenth", F.col("part") % 10)
    by_tenth = genres.genre_distinct_approx(sketches, "tenth")
    return by_tenth.union(genres.genre_distinct_approx(sketches).select(F.lit(None).cast("bigint"), "n_genres"))


def genre_frequent(spark, sf_dir):
    return genres.genre_frequent(_genre_counts(spark, sf_dir))


def genre_frequent_count(spark, sf_dir):
    return genres.genre_frequent_count(_genre_counts(spark, sf_dir))


def genre_ranked(spark, sf_dir):
    return genres.genre_ranked(_genre_counts(spark, sf_dir))


def genre_top29(spark, sf_dir):
    return genres.genre_top(_genre_counts(spark, sf_dir))


def genre_profile_frequent(spark, sf_dir):
    """Frequent genres of the whole profile, counted once, at a count the small tables reach too."""
    return genre_profile(_curated(spark, sf_dir), min_count=500).frequent


# --- cover addresses and images


def _cover_urls(spark: SparkSession, sf_dir: str, mode: str = "native") -> DataFrame:
    return with_cover_url(fixtures.page_variants(spark, sf_dir), mode=mode)


def cover_url_extract(spark, sf_dir):
    return _cover_urls(spark, sf_dir)


def cover_url_strict(spark, sf_dir):
    return _cover_urls(spark, sf_dir, "strict")


def cover_url_auto(spark, sf_dir):
    return _cover_urls(spark, sf_dir, "auto")


def valid_cover_urls(spark, sf_dir):
    return _cover_urls(spark, sf_dir).select("page_id", "img_url", is_usable_url(F.col("img_url")).alias("valid"))


def pages_with_cover(spark, sf_dir):
    return _cover_urls(spark, sf_dir).where(is_usable_url(F.col("img_url"))).select("page_id", "url", "img_url")


def pages_by_charset(spark, sf_dir):
    """Cover addresses with accents, from pages in several charsets."""
    return page_attempts(fixtures.page_bodies(spark, sf_dir), mode="native").select("url", "img_url")


def valid_geometry(spark, sf_dir):
    width, height = F.col("width"), F.col("height")
    return fixtures.image_log(spark, sf_dir).select(
        "img_url",
        "attempt",
        "width",
        "height",
        aspect_ratio(width, height).alias("ratio"),
        is_valid_geometry(width, height).alias("valid"),
    )


def cover_probe(spark, sf_dir):
    return with_image_size(fixtures.page_pictures(spark, sf_dir)).select("id", "format", "width", "height")


def _picture_files(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "pictures")
    export_cover_files(fixtures.page_pictures(spark, sf_dir), path)
    return path


def covers_scan(spark, sf_dir):
    """Pictures written as loose files, read back by a file scan."""
    files = scan_cover_files(spark, _picture_files(spark, sf_dir))
    return files.select("id", "length", sniff_format(F.col("content")).alias("format"))


def covers_in_files(spark, sf_dir):
    return existing_ids_in_files(spark, _picture_files(spark, sf_dir))


# --- collection


def scrape_input(spark, sf_dir):
    return collect.scrape_input(fixtures.scrape_input(spark, sf_dir))


def resume_todo(spark, sf_dir):
    return collect.resume_todo(fixtures.scrape_input(spark, sf_dir), fixtures.existing_covers(spark, sf_dir))


def ok_responses(spark, sf_dir):
    return collect.ok_responses(fixtures.page_log(spark, sf_dir))


def book_pages(spark, sf_dir):
    return collect.book_pages(fixtures.scrape_input(spark, sf_dir), fixtures.page_log(spark, sf_dir))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.page_attempts(_cover_urls(spark, sf_dir))
    return materialize(collect.resolve_attempts(pages, fixtures.image_log(spark, sf_dir)), "attempts")


def _outcomes(spark: SparkSession, sf_dir: str, attempts: DataFrame | None = None) -> DataFrame:
    return collect.scrape_outcomes(
        fixtures.scrape_input(spark, sf_dir),
        _attempts(spark, sf_dir) if attempts is None else attempts,
        fixtures.existing_covers(spark, sf_dir),
    )


def first_success(spark, sf_dir):
    return collect.first_success(_attempts(spark, sf_dir))


def reject_reasons(spark, sf_dir):
    return collect.reject_reasons(_attempts(spark, sf_dir))


def scrape_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


def failed_urls(spark, sf_dir):
    return collect.failed_urls(_outcomes(spark, sf_dir))


def covers_dedup(spark, sf_dir):
    attempts = _attempts(spark, sf_dir)
    return collect.covers_dedup(_outcomes(spark, sf_dir, attempts), attempts)


def run_counters(spark, sf_dir):
    return collect.run_counters(_outcomes(spark, sf_dir))


def run_progress(spark, sf_dir):
    return collect.run_progress(_outcomes(spark, sf_dir))


def outcomes_from_log(spark, sf_dir):
    """Outcomes decided from response bodies: pages searched, images sized."""
    return collect_covers(
        fixtures.scrape_input(spark, sf_dir),
        read_responses(fixtures.fetch_log(spark, sf_dir)),
        fixtures.existing_covers(spark, sf_dir),
    ).outcomes


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """The whole collection from response bodies, with the accepted bytes put in a store."""
    responses = read_responses(fixtures.fetch_log(spark, sf_dir))
    books, existing = fixtures.scrape_input(spark, sf_dir), fixtures.existing_covers(spark, sf_dir)
    store = work_path(spark, "store")
    store_covers(collect_covers(books, responses, existing), responses, store, buckets=8)
    return store


def covers_store(spark, sf_dir):
    stored = spark.read.parquet(_stored(spark, sf_dir))
    return stored.select("id", "img_url", "width", "height", F.length("content").cast("bigint").alias("length"))


def resume_after_run(spark, sf_dir):
    """Books a second run would still have to try, once the covers of the first are stored."""
    done = existing_ids(spark, _stored(spark, sf_dir))
    known = fixtures.existing_covers(spark, sf_dir).union(done)
    return collect.resume_todo(fixtures.scrape_input(spark, sf_dir), known)


QUERIES: dict[str, Query] = {
    "load_catalog": load_catalog_whole,
    "catalogue_json": _catalogue_in("json"),
    "catalogue_csv": _catalogue_in("csv", header="true", escape='"'),
    "books_with_genres": books_with_genres,
    "books_with_counts": books_with_counts,
    "books_popular": books_popular,
    "curate_books": curate_books,
    "curation_funnel": curation_funnel,
    "curated_roundtrip": curated_roundtrip,
    "sample_1000": sample_1000,
    "sample_2000": sample_2000,
    "sample_input": sample_input,
    "sample_shared_ids": sample_shared_ids,
    "genre_lists": genre_lists,
    "genre_parse_report": genre_parse_report,
    "genre_explode": genre_explode,
    "genre_counts": genre_counts,
    "genre_literals": genre_literals,
    "genre_literals_report": genre_literals_report,
    "genre_literals_frequent": genre_literals_frequent,
    "genre_literals_frequent_count": genre_literals_frequent_count,
    "genre_distinct": genre_distinct,
    "genre_distinct_approx": genre_distinct_approx,
    "genre_frequent": genre_frequent,
    "genre_frequent_count": genre_frequent_count,
    "genre_ranked": genre_ranked,
    "genre_top29": genre_top29,
    "genre_profile_frequent": genre_profile_frequent,
    "cover_url_extract": cover_url_extract,
    "cover_url_strict": cover_url_strict,
    "cover_url_auto": cover_url_auto,
    "valid_cover_urls": valid_cover_urls,
    "pages_with_cover": pages_with_cover,
    "pages_by_charset": pages_by_charset,
    "valid_geometry": valid_geometry,
    "cover_probe": cover_probe,
    "covers_scan": covers_scan,
    "covers_in_files": covers_in_files,
    "scrape_input": scrape_input,
    "resume_todo": resume_todo,
    "ok_responses": ok_responses,
    "book_pages": book_pages,
    "first_success": first_success,
    "reject_reasons": reject_reasons,
    "scrape_outcomes": scrape_outcomes,
    "failed_urls": failed_urls,
    "covers_dedup": covers_dedup,
    "run_counters": run_counters,
    "run_progress": run_progress,
    "outcomes_from_log": outcomes_from_log,
    "covers_store": covers_store,
    "resume_after_run": resume_after_run,
}

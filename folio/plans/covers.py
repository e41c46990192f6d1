"""Cover collection: from stored responses, or with the fetch job."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.collect import (
    MAX_ATTEMPTS,
    covers_dedup,
    covers_described,
    failed_urls,
    judge_images,
    judge_pages,
    resolve_attempts,
    resume_todo,
    run_counters,
    run_progress,
    scrape_input,
    scrape_outcomes,
)
from folio.operators.number import number_rows
from folio.operators.sample import RUN_SAMPLE, SEED
from folio.operators.spread import spread_join
from folio.schemas import FETCH_LOG
from folio.session import materialize
from folio.sinks.files import existing_ids_in_files, export_cover_files, finish_exports
from folio.sinks.store import BUCKETS, covers_with_content, write_covers
from folio.sources.catalog import load_catalog
from folio.sources.covers import existing_ids
from folio.sources.fetch import INTERVAL_S, TIMEOUT_S, Transport, fetch
from folio.sources.responses import image_attempts, image_bodies, in_files, page_attempts


@dataclass
class CoverRun:
    outcomes: DataFrame  # ord, id, url, attempt, outcome, reason
    covers: DataFrame  # ord, id, url, attempt, img_url, digest, length, width, height, file, row

    @property
    def counters(self) -> DataFrame:
        return run_counters(self.outcomes)

    @property
    def progress(self) -> DataFrame:
        return run_progress(self.outcomes)

    @property
    def failed(self) -> DataFrame:
        return failed_urls(self.outcomes)


@dataclass
class Responses:
    log: DataFrame  # the responses with their bodies, in files
    pages: DataFrame  # url, attempt, status, img_url
    images: DataFrame  # img_url, attempt, status, length, digest, file, row, width, height


def read_responses(fetch_log: DataFrame, mode: str = "auto") -> Responses:
    """Search the pages and size the images of a log; each body is read once."""
    fetch_log = in_files(fetch_log)
    return Responses(
        fetch_log,
        materialize(page_attempts(fetch_log, mode), "pages"),
        materialize(image_attempts(fetch_log), "images"),
    )


def collect_covers(books: DataFrame, responses: Responses, existing: DataFrame) -> CoverRun:
    """Outcome of every book from stored responses. Bytes stay in the log."""
    attempts = materialize(resolve_attempts(responses.pages, responses.images), "attempts")
    outcomes = materialize(scrape_outcomes(books, attempts, existing), "outcomes")
    covers = materialize(covers_described(covers_dedup(outcomes, attempts), responses.images), "covers")
    return CoverRun(outcomes, covers)


def store_covers(run: CoverRun, responses: Responses, store: str, buckets: int = BUCKETS) -> None:
    """Append the covers of a run, with their bytes, to the store."""
    write_covers(run.covers, image_bodies(responses.log), store, buckets)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(FETCH_LOG).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FETCH_LOG)


#: Addresses asked between two appends to the log, when the number of slices is not stated.
SLICE_URLS = 50_000


def _fetch_missing(urls: DataFrame, log_path: str, transport: Transport, kind: str, attempt: int, slices: int | None, **pace):
    """Append the responses of one attempt, slice by slice; recorded addresses are not asked again.

    A slice that was written stays written whatever happens to the executors afterwards. Without ``slices`` there
    are as many as keep each below about ``SLICE_URLS`` addresses.
    """
    spark = urls.sparkSession
    here = (F.col("kind") == kind) & (F.col("attempt") == attempt)
    done = read_log(spark, log_path).where(here).select("url").distinct()
    missing = materialize(urls.select("url").distinct().join(done, "url", "left_anti"), "missing")
    if slices is None:
        slices = -(-missing.count() // SLICE_URLS)
    for part in range(slices):
        slice_ = missing.where(F.pmod(F.xxhash64("url", F.lit("slice")), F.lit(slices)) == part)
        rows = fetch(slice_, transport, kind, attempt, **pace)
        rows.write.mode("append").partitionBy("kind", "attempt").parquet(log_path)


def fetch_attempts(
    todo: DataFrame,
    log_path: str,
    transport: Transport,
    max_attempts: int = MAX_ATTEMPTS,
    slices: int | None = None,
    mode: str = "auto",
    **pace,
) -> Responses:
    """Fill the log at ``log_path`` for the books of ``todo``.

    Each attempt is the whole chain – page, address check, image, image check – for the addresses
    no earlier attempt has settled.
    """
    spark = todo.sparkSession
    open_urls = todo.select("url").where(F.col("url").isNotNull()).distinct()
    pages, images = [], []
    for attempt in range(1, max_attempts + 1):
        if open_urls.isEmpty():
            break
        this = F.col("attempt") == attempt
        _fetch_missing(open_urls, log_path, transport, "page", attempt, slices, **pace)
        pages.append(materialize(page_attempts(read_log(spark, log_path).where(this), mode), "pages"))
        asked = judge_pages(pages[-1], max_attempts).where(F.col("page_code") == 0)
        _fetch_missing(
            asked.select(F.col("img_url").alias("url")), log_path, transport, "image", attempt, slices, **pace
        )
        images.append(materialize(image_attempts(read_log(spark, log_path).where(this)), "images"))
        good = judge_images(images[-1], max_attempts).where(F.col("image_code") == 0).select("img_url")
        settled = spread_join(asked, good, ["img_url"], "left_semi").select("url").distinct()
        open_urls = materialize(open_urls.join(settled, "url", "left_anti"), "open")
    log = read_log(spark, log_path)
    if not pages:  # nothing was open
        return read_responses(log, mode)
    return Responses(log, reduce(DataFrame.union, pages), reduce(DataFrame.union, images))


def run(
    spark: SparkSession,
    curated: str,
    store: str,
    log: str,
    transport: Transport,
    run_id: str,
    sample_size: int | None = RUN_SAMPLE,
    seed: int = SEED,
    strict: bool = True,
    slices: int | None = None,
    buckets: int = BUCKETS,
    timeout: float = TIMEOUT_S,
    interval: float = INTERVAL_S,
    images: str | None = None,
) -> CoverRun:
    """Sample the curated table, fetch what has no cover yet, store the accepted covers, report.

    Give a new ``run_id`` for a new try at the books that are still open, and the old one to go on
    with a run that broke off. With ``images``, a book that has a file ``{id}.jpg`` in that folder is not tried either,
    and the covers of the run are put there as files, too.
    """
    books = scrape_input(number_rows(load_catalog(spark, curated, sample_size, seed, strict)))
    books = materialize(books, "books")
    existing = existing_ids(spark, store)
    if images is not None:
        finish_exports(spark, images)
        existing = existing.union(existing_ids_in_files(spark, images)).distinct()
    existing = materialize(existing, "existing")
    responses = fetch_attempts(
        resume_todo(books, existing),
        f"{log.rstrip('/')}/run={run_id}",
        transport,
        slices=slices,
        timeout=timeout,
        interval=interval,
    )
    result = collect_covers(books, responses, existing)
    store_covers(result, responses, store, buckets)
    if images is not None:
        export_cover_files(covers_with_content(result.covers, image_bodies(responses.log)), images)
    return result

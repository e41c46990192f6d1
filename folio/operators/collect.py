"""Cover collection stated on tables: attempts, outcomes, covers, counters.

Tables used here

* ``books``: ``ord, id, url`` – the books in run order
* ``page_attempts``: ``url, attempt, status, img_url`` – one page response and the cover address in it
* ``image_attempts``: ``img_url, attempt, status, width, height`` – one image response and its size
* ``attempts``: ``url, attempt, img_url, reason`` – the whole chain of one attempt; reason null = success
* ``existing``: ``id`` – books that already have a cover
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.images import is_too_small, is_too_wide, is_valid_geometry
from folio.functions.urls import BAD_KEYWORDS, cover_target, has_bad_keyword
from folio.operators.number import running_totals
from folio.operators.sift import anti_join
from folio.operators.spread import spread_join
from folio.schemas import require_columns
from folio.session import materialize

# Attempts per book, the status that counts as an answer, rows between progress lines.
MAX_ATTEMPTS = 3
OK_STATUS = 200
PROGRESS_EVERY = 50

# Why an attempt fails, in the order the checks are made. Codes are positions here, from 1; 0 is success.
REASONS = (
    "no_page",
    "bad_status",
    "no_cover_url",
    "bad_keyword",
    "bad_image_status",
    "unreadable",
    "too_small",
    "too_wide",
)
_CODE = {reason: code for code, reason in enumerate(REASONS, 1)}


def _reason(code: Column) -> Column:
    return F.get(F.array(*map(F.lit, REASONS)), code - 1)


def _ladder(*steps: tuple[Column, str]) -> Column:
    """Code of the first step whose condition holds, else 0."""
    first, *rest = steps
    ladder = F.when(first[0], _CODE[first[1]])
    return reduce(lambda built, step: built.when(step[0], _CODE[step[1]]), rest, ladder).otherwise(0)


def scrape_input(books: DataFrame, directory: str = "images") -> DataFrame:
    """``ord, id, url, target``; a book without id is an error, not a file called None."""
    require_columns(books, "ord", "id", "url")
    book_id = F.coalesce(F.col("id").cast("string"), F.raise_error(F.lit("book without id")).cast("string"))
    return books.select("ord", book_id.alias("id"), "url").withColumn("target", cover_target(directory, F.col("id")))


def resume_todo(books: DataFrame, existing: DataFrame) -> DataFrame:
    """Books that have no cover yet.

    The ids of both sides go through a filter of the other's; only what may match is shuffled.
    """
    return anti_join(books, existing, ["id"], lambda left, right: spread_join(left, right, ["id"], "left_anti"))


def ok_responses(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("status") == OK_STATUS)


def book_pages(books: DataFrame, page_log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Each book with its page responses; a book without any keeps one row of nulls.

    Repeated records of an attempt count once; an OK one is preferred.
    """
    status = F.col("status")
    once = (
        page_log.where(F.col("attempt") <= max_attempts)
        .groupBy("url", "attempt")
        .agg(F.max(status == OK_STATUS).alias("ok"), F.min("status").alias("low"))
        .select("url", "attempt", F.when(F.col("ok"), OK_STATUS).otherwise(F.col("low")).alias("status"))
    )
    return spread_join(books.select("ord", "id", "url"), once, ["url"], "left")


def judge_pages(
    page_attempts: DataFrame,
    max_attempts: int = MAX_ATTEMPTS,
    keywords: Sequence[str] = BAD_KEYWORDS,
) -> DataFrame:
    """``url, attempt, img_url, page_code`` of the page half of each attempt."""
    status, img_url = F.col("status"), F.col("img_url")
    code = _ladder(
        (status.isNull(), "no_page"),
        (status != OK_STATUS, "bad_status"),
        (img_url.isNull() | (img_url == ""), "no_cover_url"),
        (has_bad_keyword(img_url, keywords), "bad_keyword"),
    )
    return page_attempts.where(F.col("attempt") <= max_attempts).select(
        "url", F.col("attempt").cast("int").alias("attempt"), "img_url", code.alias("page_code")
    )


def judge_images(image_attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``img_url, attempt, image_code``, one row each; of repeated records the best counts."""
    status, width, height = F.col("status"), F.col("width"), F.col("height")
    code = _ladder(
        (F.coalesce(status != OK_STATUS, F.lit(True)), "bad_image_status"),
        (width.isNull() | height.isNull(), "unreadable"),
        (is_too_small(width, height), "too_small"),
        (is_too_wide(width, height), "too_wide"),
    )
    best = F.min(F.when(code == 0, 0).otherwise(len(REASONS) + 1 - code))
    return (
        image_attempts.where(F.col("attempt") <= max_attempts)
        .groupBy("img_url", F.col("attempt").cast("int").alias("attempt"))
        .agg(best.alias("best"))
        .select(
            "img_url",
            "attempt",
            F.when(F.col("best") == 0, 0).otherwise(len(REASONS) + 1 - F.col("best")).alias("image_code"),
        )
    )


def resolve_attempts(
    page_attempts: DataFrame,
    image_attempts: DataFrame,
    max_attempts: int = MAX_ATTEMPTS,
    keywords: Sequence[str] = BAD_KEYWORDS,
) -> DataFrame:
    """``url, attempt, img_url, reason`` for the whole chain of each attempt.

    Page bodies are reduced to addresses before anything is shuffled, and that narrow table is
    written once: it feeds the join, the outcomes and the covers.
    """
    pages = materialize(judge_pages(page_attempts, max_attempts, keywords), "pages")
    images = judge_images(image_attempts, max_attempts)
    # An address the page half rejects joins with nothing.
    asked = pages.withColumn("asked", F.when(F.col("page_code") == 0, F.col("img_url")))
    joined = spread_join(asked, images.withColumnRenamed("img_url", "asked"), ["asked", "attempt"], "left")
    code = F.when(F.col("page_code") != 0, F.col("page_code")).otherwise(
        F.coalesce(F.col("image_code"), F.lit(_CODE["bad_image_status"]))
    )
    return joined.select("url", "attempt", "img_url", _reason(code).alias("reason"))


def first_success(attempts: DataFrame) -> DataFrame:
    """``url, attempt``: the first attempt that succeeded, for the addresses that have one."""
    return attempts.where(F.col("reason").isNull()).groupBy("url").agg(F.min("attempt").alias("attempt"))


def reject_reasons(attempts: DataFrame) -> DataFrame:
    return attempts.where(F.col("reason").isNotNull()).select("url", "attempt", "reason")


def url_verdicts(attempts: DataFrame) -> DataFrame:
    """``url, attempt, reason``: first success, or the reason of the last attempt when there is none.

    Attempt and reason code share one whole number, so the aggregation stays a hash aggregation.
    """
    attempt = F.col("attempt")
    base = len(REASONS) + 1
    code = reduce(
        lambda built, reason: built.when(F.col("reason") == reason, _CODE[reason]),
        REASONS[1:],
        F.when(F.col("reason") == REASONS[0], _CODE[REASONS[0]]),
    )
    return (
        attempts.groupBy("url")
        .agg(
            F.min(F.when(F.col("reason").isNull(), attempt)).alias("attempt"),
            F.max(attempt * base + code).alias("last"),
        )
        .select(
            "url",
            "attempt",
            F.when(F.col("attempt").isNull(), _reason(F.pmod(F.col("last"), F.lit(base)))).alias("reason"),
        )
    )


def scrape_outcomes(books: DataFrame, attempts: DataFrame, existing: DataFrame) -> DataFrame:
    """``ord, id, url, attempt, outcome, reason`` for every book.

    A book is skipped when its cover exists or an earlier row of the same id succeeded. The first
    success of an id comes from an aggregation joined back, so an id held by very many rows is
    reduced before the shuffle and never gathered in one task.
    """
    judged = spread_join(books.select("ord", "id", "url"), url_verdicts(attempts), ["url"], "left")
    judged = materialize(judged.select("ord", "id", "url", "attempt", "reason"), "judged")
    successes = judged.where(F.col("attempt").isNotNull()).select("id", F.lit(False).alias("pre"), "ord")
    known = existing.select(F.col("id"), F.lit(True).alias("pre"), F.lit(None).cast("bigint").alias("ord"))
    by_id = successes.unionByName(known).groupBy("id").agg(F.max("pre").alias("pre"), F.min("ord").alias("first_ord"))
    outcome = (
        F.when(F.col("pre") | (F.col("ord") > F.col("first_ord")), "skipped")
        .when(F.col("attempt").isNotNull(), "success")
        .otherwise("failed")
    )
    reason = F.when(F.col("outcome") == "failed", F.coalesce(F.col("reason"), F.lit("no_page")))
    return (
        spread_join(judged, by_id, ["id"], "left")
        .withColumn("outcome", outcome)
        .select("ord", "id", "url", "attempt", "outcome", reason.alias("reason"))
    )


def failed_urls(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("outcome") == "failed").select("ord", "url")


def covers_dedup(outcomes: DataFrame, attempts: DataFrame) -> DataFrame:
    """``ord, id, url, attempt, img_url`` of the one success each id keeps."""
    won = outcomes.where(F.col("outcome") == "success").select("ord", "id", "url", "attempt")
    found = (
        attempts.where(F.col("reason").isNull())
        .groupBy("url", "attempt")
        .agg(F.min("img_url").alias("img_url"))
    )
    return spread_join(won, found, ["url", "attempt"]).select("ord", "id", "url", "attempt", "img_url")


def covers_described(covers: DataFrame, images: DataFrame) -> DataFrame:
    """Add ``length, digest, width, height`` of the accepted image and where the log has it: ``file, row`` of one record."""
    good = images.where((F.col("status") == OK_STATUS) & is_valid_geometry(F.col("width"), F.col("height")))
    image = F.min(F.struct("digest", "length", "width", "height", "file", "row")).alias("image")
    once = good.groupBy("img_url", "attempt").agg(image)
    return spread_join(covers, once, ["img_url", "attempt"]).select(*covers.columns, "image.*")


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row with the totals; skipped books are in neither."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == "success").alias("success"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )


def run_progress(outcomes: DataFrame, every: int = PROGRESS_EVERY) -> DataFrame:
    """``i, success, failed``: totals up to and with row ``i``, at every 50th row that was not skipped."""
    is_point = (F.pmod("ord", F.lit(every)) == 0) & (F.col("outcome") != "skipped")
    steps = outcomes.groupBy(F.ceil(F.col("ord") / every).alias("step")).agg(
        F.count_if(F.col("outcome") == "success").alias("success"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.max(is_point).alias("is_point"),
    )
    return (
        # Written once, as the totals are read twice.
        running_totals(materialize(steps, "steps"), "step", ["success", "failed"])
        .where("is_point")
        .select((F.col("step") * every).alias("i"), "success", "failed")
    )

"""Collection on tables against a plain loop over the same responses."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.operators import collect

IMAGES = {
    "ok": (200, 200, 300, None),
    "edge": (200, 180, 150, None),
    "gone": (404, 200, 300, "bad_image_status"),
    "junk": (200, None, None, "unreadable"),
    "small": (200, 99, 300, "too_small"),
    "wide": (200, 181, 150, "too_wide"),
    "missing": (None, None, None, "bad_image_status"),
}
PAGES = {
    "error": (None, None, "no_page"),
    "down": (503, None, "bad_status"),
    "other 2xx": (204, None, "bad_status"),
    "bare": (200, None, "no_cover_url"),
    "blank": (200, "", "no_cover_url"),
    "placeholder": (200, "https://i/LOGO.png", "bad_keyword"),
}


def loop(books, answers, existing, every=50):
    """What a run over the books one after the other does."""
    have, outcomes, progress, success, failed = set(existing), {}, [], 0, 0
    for i, (book_id, url) in enumerate(books):
        if book_id in have:
            outcomes[i] = ("skipped", None)
            continue
        last = "no_page"
        for attempt in (1, 2, 3):
            if (url, attempt) not in answers:
                continue
            last = answers[url, attempt]
            if last is None:
                success += 1
                have.add(book_id)
                outcomes[i] = ("success", None)
                break
        else:
            failed += 1
            outcomes[i] = ("failed", last)
        if i % every == 0:
            progress.append((i, success, failed))
    return outcomes, progress, (success, failed)


def tables(spark, books, kinds, existing):
    """Responses as tables, and the reason each attempt ends with."""
    pages, images, answers = [], [], {}
    for (url, attempt), kind in kinds.items():
        if kind in PAGES:
            status, img_url, reason = PAGES[kind]
        else:
            status, img_url = 200, f"https://i/{url}/{attempt}.jpg"
            image_status, width, height, reason = IMAGES[kind]
            if kind != "missing":
                images.append((img_url, attempt, image_status, width, height))
        pages.append((url, attempt, status, img_url))
        answers[url, attempt] = reason
    rows = [(i, book_id, url) for i, (book_id, url) in enumerate(books)]
    return (
        spark.createDataFrame(rows, "ord bigint, id string, url string"),
        spark.createDataFrame(pages, "url string, attempt int, status int, img_url string"),
        spark.createDataFrame(images, "img_url string, attempt int, status int, width int, height int"),
        spark.createDataFrame([(i,) for i in existing], "id string"),
        answers,
    )


def check(spark, books, kinds, existing, every=50):
    books_df, pages, images, existing_df, answers = tables(spark, books, kinds, existing)
    attempts = collect.resolve_attempts(pages, images)
    outcomes = collect.scrape_outcomes(books_df, attempts, existing_df).cache()
    want, progress, totals = loop(books, answers, existing, every)
    assert {row.ord: (row.outcome, row.reason) for row in outcomes.collect()} == want
    assert tuple(collect.run_counters(outcomes).first()) == totals
    assert sorted(map(tuple, collect.run_progress(outcomes, every).collect())) == progress
    won = sorted((row.ord, row.id) for row in collect.covers_dedup(outcomes, attempts).collect())
    assert won == [(i, books[i][0]) for i, (outcome, _) in sorted(want.items()) if outcome == "success"]
    assert sorted(row.ord for row in collect.failed_urls(outcomes).collect()) == [
        i for i, (outcome, _) in sorted(want.items()) if outcome == "failed"
    ]


@settings(max_examples=4, deadline=None)
@given(st.data())
def test_same_as_the_loop(spark, data):
    n_urls = data.draw(st.integers(1, 12))
    kinds = st.sampled_from(["ok", "edge", *IMAGES, *PAGES])
    made = {
        (f"u{u}", a): data.draw(kinds)
        for u in range(n_urls)
        for a in range(1, data.draw(st.integers(1, 4)) + 1)
    }
    books = data.draw(
        st.lists(
            st.tuples(st.integers(0, 14).map(str), st.integers(0, n_urls).map(lambda u: f"u{u}")),
            min_size=1,
            max_size=60,
        )
    )
    existing = data.draw(st.lists(st.integers(0, 14).map(str), max_size=3))
    check(spark, books, made, existing, every=data.draw(st.sampled_from([1, 7, 50])))


def test_every_reason(spark):
    kinds = {(name, 1): name for name in [*PAGES, *IMAGES]}
    _, pages, images, _, answers = tables(spark, [("1", "u")], kinds, [])
    attempts = collect.resolve_attempts(pages, images)
    rejected = {(row.url, row.attempt): row.reason for row in collect.reject_reasons(attempts).collect()}
    assert rejected == {key: reason for key, reason in answers.items() if reason}
    assert {row.url for row in collect.first_success(attempts).collect()} == {"ok", "edge"}


def test_fourth_attempt_does_not_count(spark):
    kinds = {("u", 1): "down", ("u", 2): "gone", ("u", 3): "small", ("u", 4): "ok"}
    check(spark, [("1", "u")], kinds, [])


def test_fail_success_success_with_one_id(spark):
    kinds = {("a", 1): "down", ("b", 2): "ok", ("c", 1): "ok"}
    check(spark, [("1", "a"), ("1", "b"), ("1", "c"), ("2", "none")], kinds, [])


def test_repeated_records_count_once(spark):
    books, pages, images, existing, _ = tables(spark, [("1", "u")], {("u", 1): "ok"}, [])
    attempts = collect.resolve_attempts(pages.union(pages), images.union(images))
    outcomes = collect.scrape_outcomes(books, attempts, existing)
    assert collect.covers_dedup(outcomes, attempts).count() == 1
    assert collect.book_pages(books, pages.union(pages)).count() == 1


def test_hot_id_and_hot_address(spark, monkeypatch):
    """A third of the books share an id, a third an address; joins take the spread path."""
    monkeypatch.setattr(collect, "spread_join", lambda *a, **k: _spread(*a, **k))
    books = [("hot" if i % 3 == 0 else str(i), "u0" if i % 3 == 1 else f"u{i % 40}") for i in range(600)]
    kinds = {(f"u{u}", a): ["ok", "down", "gone", "small"][(u + a) % 4] for u in range(38) for a in (1, 2, 3)}
    check(spark, books, kinds, ["5", "7"])


def _spread(left, right, keys, how="inner"):
    from folio.operators.spread import spread_join

    return spread_join(left, right, keys, how, small_rows=0, lanes=32)


def test_missing_response_and_missing_id(spark):
    books = spark.createDataFrame([(0, "1", "none"), (1, "2", None)], "ord bigint, id string, url string")
    log = spark.createDataFrame([], "url string, attempt int, status int")
    assert [row.status for row in collect.book_pages(books, log).collect()] == [None, None]
    nameless = spark.createDataFrame([(0, None, "u")], "ord bigint, id string, url string")
    with pytest.raises(Exception, match="book without id"):
        collect.scrape_input(nameless).collect()


def test_only_200_is_ok(spark):
    df = spark.createDataFrame([(s,) for s in (200, 201, 204, 206, 301, 404, None)], "status int")
    assert [row.status for row in collect.ok_responses(df).collect()] == [200]


def test_progress_of_a_long_run(spark):
    n = 3017
    outcomes = spark.range(n).select(
        F.col("id").alias("ord"),
        F.expr("CASE WHEN id % 7 = 0 THEN 'skipped' WHEN id % 3 = 0 THEN 'failed' ELSE 'success' END").alias("outcome"),
    )
    kind = ["skipped" if i % 7 == 0 else "failed" if i % 3 == 0 else "success" for i in range(n)]
    want = [
        (i, kind[: i + 1].count("success"), kind[: i + 1].count("failed"))
        for i in range(0, n, 50)
        if kind[i] != "skipped"
    ]
    assert sorted(map(tuple, collect.run_progress(outcomes).collect())) == want

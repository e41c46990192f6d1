"""The plans are the ones meant to run at scale."""

import pytest
from compare import plan
from pyspark.sql import functions as F

from folio.functions.html import with_cover_url
from folio.functions.urls import is_usable_url
from folio.operators import curate, genres
from folio.operators.sample import sample_exact
from folio.session import work_path

@pytest.fixture(scope="module")
def stored(spark):
    path = work_path(spark, "books")
    spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS id",
        "concat('u', id) AS url",
        "'[\"a\"]' AS genres",
        "id * 100 AS num_ratings",
        "id AS num_reviews",
        "repeat('x', 50) AS blurb",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_curation_filters_reach_the_scan(stored):
    text = plan(curate.curate(stored).select("id"))
    assert "GreaterThan(num_ratings,7500)" in text and "IsNotNull(num_reviews)" in text
    assert "Not(EqualTo(genres,[]))" in text
    assert text.count("Filter") <= 3 and "blurb" not in text  # one filter, pruned scan


def test_top_genres_are_not_fully_sorted(stored):
    text = plan(genres.genre_top(genres.genre_counts(stored)))
    assert "TakeOrderedAndProject" in text
    # Partial counts come before the first shuffle, Python only after it.
    tree = text[: text.index("(1)")] if "(1)" in text else text
    assert tree.index("ArrowEvalPython") < tree.rindex("Exchange") < tree.rindex("HashAggregate")


def test_items_are_split_once(stored):
    assert plan(genres.genre_counts(stored)).count("regexp_extract_all") <= 2  # optimized once, printed per node


def test_sample_sorts_only_what_is_drawn(stored):
    text = plan(sample_exact(stored, 10))
    # Rows meet the hashes that were drawn; nothing gathers the top n of all rows in one task.
    assert "LeftSemi" in text and "TakeOrderedAndProject" not in text and "Window" not in text
    tree = text[: text.index("(1)")]
    assert tree.index("Sort") < tree.index("Join")


def test_native_extraction_has_no_shuffle_and_no_python(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text = plan(with_cover_url(pages))
    assert "Exchange" not in text and "Python" not in text


def test_filters_on_the_address_do_not_repeat_the_search(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = with_cover_url(pages)
    kept = found.where(is_usable_url(F.col("img_url")))
    assert plan(kept).count("regexp_extract(") == plan(found).count("regexp_extract(")

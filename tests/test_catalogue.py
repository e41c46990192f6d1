import pytest
from pyspark.sql import functions as F

from folio.operators import curate
from folio.plans.catalogue import curate_to
from folio.session import work_path
from folio.sources.catalog import load_books, load_catalog


def ids(df):
    return sorted(row.id for row in df.collect())


def test_genres_present(spark):
    rows = [("a", None), ("b", "[]"), ("c", "[ ]"), ("d", " []"), ("e", "['x']")]
    df = spark.createDataFrame(rows, "id string, genres string")
    assert ids(curate.books_with_genres(df)) == ["c", "d", "e"]


def test_genres_present_in_array(spark):
    df = spark.createDataFrame([("a", None), ("b", []), ("c", ["x"])], "id string, genres array<string>")
    assert ids(curate.books_with_genres(df)) == ["c"]


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_counts_and_threshold(spark, kind):
    rows = [("low", 7500, 0), ("over", 7501, 0), ("no ratings", None, 1), ("no reviews", 9000, None)]
    df = spark.createDataFrame(rows, "id string, num_ratings bigint, num_reviews bigint").withColumns(
        {name: F.col(name).cast(kind) for name in ("num_ratings", "num_reviews")}
    )
    assert ids(curate.books_with_counts(df)) == ["low", "over"]
    assert ids(curate.books_popular(df)) == ["no reviews", "over"]


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", nan, 1.0), ("b", 9000.0, nan), ("c", 9000.0, 0.0)], "id string, num_ratings double, num_reviews double")
    assert ids(curate.books_with_counts(df)) == ["c"]
    assert ids(curate.books_popular(df)) == ["b", "c"]


def test_funnel_counts_each_step(spark):
    rows = [("[]", 9000, 1), ("['a']", None, 1), ("['a']", 10, 1), ("['a']", 9000, 1)]
    df = spark.createDataFrame(rows, "genres string, num_ratings bigint, num_reviews bigint")
    assert tuple(curate.curation_funnel(df).first()) == (4, 3, 2, 1)


def test_missing_column(spark):
    with pytest.raises(ValueError, match="num_reviews"):
        curate.books_with_counts(spark.createDataFrame([(1,)], "num_ratings bigint"))


BOOK = ("7", "https://b/7", '["A, \\"B\\"", "C"]', 9000, 3, 'say "hi", twice')


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_formats_and_extra_columns(spark, fmt):
    path = work_path(spark, "in")
    df = spark.createDataFrame([BOOK], "id string, url string, genres string, num_ratings bigint, num_reviews bigint, note string")
    df.write.options(header="true", escape='"').format(fmt).save(f"{path}/train")
    row = load_books(spark, path, fmt, split="train").first()
    assert (row.id, row.genres, row.num_ratings, row.note) == (BOOK[0], BOOK[2], 9000, BOOK[5])


def test_bad_number_in_text_fails(spark):
    path = work_path(spark, "bad")
    spark.createDataFrame([("1", "u", "[]", "many", "2")], "id string, url string, genres string, num_ratings string, num_reviews string").write.option("header", "true").csv(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_books(spark, path, "csv").collect()


def test_numeric_id_becomes_text(spark):
    path = work_path(spark, "num")
    spark.range(3).selectExpr("id", "'u' url", "'[]' genres", "1L num_ratings", "1L num_reviews").write.parquet(path)
    assert dict(load_books(spark, path).dtypes)["id"] == "string"


def test_curated_table_is_overwritten(spark):
    source, target = work_path(spark, "src"), work_path(spark, "cur")
    spark.createDataFrame([BOOK], "id string, url string, genres string, num_ratings bigint, num_reviews bigint, note string").write.parquet(source)
    curate_to(spark, source, target)
    curated = curate_to(spark, source, target)
    assert curated.books.count() == 1
    assert curated.funnel == {"n_books": 1, "n_with_genres": 1, "n_with_counts": 1, "n_popular": 1}
    assert load_catalog(spark, target).columns == ["id", "url", "genres", "num_ratings", "num_reviews", "note"]


def test_csv_keeps_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "books.csv").write_text('id,title,url,genres,num_ratings,num_reviews\n1,"one ""x""\nline",u,[],5,1\n2,two,u,[],6,2\n')
    rows = load_books(spark, str(tmp_path / "books.csv"), "csv").orderBy("id").collect()
    assert [(r.id, r.title, r.num_ratings) for r in rows] == [("1", 'one "x"\nline', 5.0), ("2", "two", 6.0)]

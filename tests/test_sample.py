import hashlib
from collections import Counter

import pytest
from compare import plan

from folio.operators.sample import key_limit, maybe_sample, sample_exact


def books(spark, n):
    return spark.range(n).selectExpr("CAST(id AS STRING) AS id", "id * 2 AS other")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def smallest(rows, n, seed=42):
    """The rows with the least keys, for rows of ``id, other``."""
    met, keys = Counter(), []
    for row in rows:
        met[row] += 1
        digest = md5("".join("-" if v is None else f"{len(str(v))}:{v}" for v in row))
        keys.append((md5(f"{seed}:{digest}:{met[row]}"), row))
    return [row for _, row in sorted(keys, key=lambda k: k[0])[:n]]


def drawn(df, n, **options):
    return [tuple(row) for row in sample_exact(df, n, **options).collect()]


@pytest.mark.parametrize("n", [0, 1, 700, 4999, 5000, 5001])
def test_exact_size_and_choice(spark, n):
    df = books(spark, 5000)
    got = drawn(df, n)
    assert got == smallest([(str(i), 2 * i) for i in range(5000)], n)
    assert got == drawn(df.repartition(7).select("other", "id").select("id", "other"), n)


def test_seed_and_column_order(spark):
    df = books(spark, 500)
    assert drawn(df, 20) != drawn(df, 20, seed=1)
    assert [t[::-1] for t in drawn(df, 20)] == drawn(df.select("other", "id"), 20)


def test_rows_that_share_an_id_are_drawn_each(spark):
    rows = [("hot", k) for k in range(3000)] + [("same", 7)] * 2000 + [(None, None)] * 500 + [(str(k), k) for k in range(500)]
    df = spark.createDataFrame(rows, "id string, other bigint").repartition(6)
    got = drawn(df, 1500)
    assert got == smallest(rows, 1500)
    count = Counter(i if i in ("hot", "same", None) else "other" for i, _ in got)
    # About a quarter of each group of rows: within five standard deviations of it.
    for group, size in (("hot", 3000), ("same", 2000), (None, 500), ("other", 500)):
        assert abs(count[group] - size / 4) < 5 * (size * 3 / 16) ** 0.5


def test_all_kinds_of_columns(spark):
    df = spark.sql(
        "SELECT id, array(id, null) a, named_struct('x', id % 3) s, map('k', id) m, CAST(id AS DOUBLE) / 7 d,"
        " CAST(CAST(id AS STRING) AS BINARY) b, DATE '2020-01-01' `odd name` FROM range(50)"
    )
    assert len({row.id for row in sample_exact(df, 20).collect()}) == 20


def test_key_limit_is_the_last_key(spark):
    keys = [md5(str(k)) for k in range(300)] + ["0000" + md5(str(k))[4:] for k in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "_key string")
    for n in (1, 2, 150, 299, 300, 301, 600):
        limit = key_limit(df, n)
        assert sorted(keys)[:n] == sorted(k for k in keys if k[: len(limit)] <= limit)


def test_rows_come_whole(spark):
    assert all(int(row.id) * 2 == row.other for row in sample_exact(books(spark, 100), 10).collect())


def test_too_many(spark):
    assert sample_exact(books(spark, 10), 11).count() == 10
    with pytest.raises(ValueError, match="without replacement"):
        sample_exact(books(spark, 10), 11, strict=True)


def test_no_size_means_all(spark):
    assert maybe_sample(books(spark, 10), None).count() == 10


def test_empty(spark):
    assert sample_exact(books(spark, 0), 5).count() == 0


def test_one_plan_for_every_size(spark):
    df = books(spark, 3000)
    shape = lambda n: [line.split("(")[0].strip() for line in plan(sample_exact(df, n)).splitlines() if line.startswith("(")]
    assert shape(10) == shape(2500)

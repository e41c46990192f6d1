"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import duck, duck_rows, plan, spark_rows

import __spark_entry__ as driver
from folio.oracle import ORACLE as SQL
from folio.registry import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_flagship(spark):
    assert driver.entry(spark).columns == ["genre", "count"]


# Queries whose own plan calls Python on purpose: full page parses, image headers, odd genre texts.
WITH_PYTHON = {"cover_url_strict", "cover_url_auto", "cover_probe"} | {name for name in QUERIES if name.startswith("genre_")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, connection, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert spark_rows(df) == duck_rows(connection, SQL[name])
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "BatchEvalPython" not in text
    assert name in WITH_PYTHON or ("Python" not in text and "InArrow" not in text and "InPandas" not in text)

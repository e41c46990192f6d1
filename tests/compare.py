"""Run queries in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import contextlib
import io
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return bytes(value) if isinstance(value, (bytearray, memoryview)) else value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(_plain(row[at]) for at in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), normal(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    return sorted(columns), normal(columns, result.fetchall())


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()

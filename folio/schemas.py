"""Table schemas and the check for missing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BOOKS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("genres", T.StringType()),
        T.StructField("num_ratings", T.LongType()),
        T.StructField("num_reviews", T.LongType()),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("kind", T.StringType()),  # 'page' or 'image'
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),  # null when the request itself failed
        T.StructField("body", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("charset", T.StringType()),  # as the response states it, null when it does not
    ]
)

COVERS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("img_url", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))

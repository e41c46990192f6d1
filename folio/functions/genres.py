"""Genre list literals to arrays."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# A list of quoted items without escapes reads the same as JSON, as a Python literal and by pattern.
_ITEM = r"""(?:'[^'\\\r\n\x00]*+'|"[^"\\\r\n\x00]*+")"""
_SPACE = r"[ \t\r\n]*+"
PLAIN_LIST = rf"^[ \t]*+\[{_SPACE}(?:{_ITEM}{_SPACE}(?:,{_SPACE}{_ITEM}{_SPACE})*+(?:,{_SPACE})?)?\]{_SPACE}$"
_PLAIN_ITEMS = r"""(['"])(.*?)\1"""


def is_plain_list(genres: Column) -> Column:
    """Whether the text can be split by pattern alone."""
    return genres.rlike(PLAIN_LIST)


def split_plain_list(genres: Column) -> Column:
    """Items of a list for which ``is_plain_list`` holds."""
    return F.regexp_extract_all(genres, F.lit(_PLAIN_ITEMS), F.lit(2))


def _storable(text: str) -> str:
    """Join escaped surrogate pairs; a lone half cannot be stored and becomes the replacement sign."""
    if text.isascii():
        return text
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def read_literal(text: str) -> list[str | None] | None:
    """Items of a Python sequence literal, or None when the text is not one."""
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if not isinstance(value, (list, tuple, set)):
        return None
    if any(isinstance(item, (list, dict, set, tuple)) for item in value):
        return None
    return [None if item is None else _storable(str(item)) for item in value]


@pandas_udf(T.ArrayType(T.StringType()))
def _read_literals(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else read_literal(text))


@pandas_udf(T.ArrayType(T.StringType()))
def _read_literals_or_fail(texts: pd.Series) -> pd.Series:
    def read(text):
        if text is None:
            return None
        items = read_literal(text)
        if items is None:
            raise ValueError(f"not a genre list: {text[:200]!r}")
        return items

    return texts.map(read)


def read_odd_list(genres: Column, fail: bool = False) -> Column:
    """Items of any other literal. Only the rows that need it carry text into Python."""
    reader = _read_literals_or_fail if fail else _read_literals
    return reader(F.when(~is_plain_list(genres), genres))


def parse_genres(genres: Column, fail: bool = False) -> Column:
    """Array of genres for a list literal; null for malformed text, or an error with ``fail``."""
    return F.when(is_plain_list(genres), split_plain_list(genres)).otherwise(read_odd_list(genres, fail))

"""Exact-size reproducible sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.session import materialize

# The seed and the two sample sizes in use.
SEED = 42
NOTEBOOK_SAMPLE = 1000
RUN_SAMPLE = 2000

# Keys are counted by so many further hex digits at a time: at most 65,536 counts.
_DIGITS = 4
_KEY_DIGITS = 32


def _as_text(df: DataFrame, field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(value)
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(F.struct(value))
    return value.cast("string")


def row_digest(df: DataFrame) -> Column:
    """Hash of all columns of a row, by name: equal for equal rows, whatever the order of columns and rows."""

    def part(field: T.StructField) -> Column:
        text = _as_text(df, field)
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    fields = sorted(df.schema.fields, key=lambda field: field.name)
    return F.md5(F.concat(F.lit(""), *map(part, fields)).cast("binary"))


def _copies(digests: DataFrame, seed: int) -> DataFrame:
    """``_digest, _copy, _key``: a key of its own for each of ``_n`` equal rows."""
    copies = digests.select("_digest", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    text = F.concat(F.lit(f"{seed}:"), F.col("_digest"), F.lit(":"), F.col("_copy").cast("string"))
    return copies.withColumn("_key", F.md5(text.cast("binary")))


def key_limit(keys: DataFrame, n: int) -> str:
    """The beginning of the ``n``-th key: the keys up to it, and no others, are the ``n`` smallest.

    Keys are counted by their first digits, then those of the range the ``n``-th is in by their next digits, until the
    range ends with it. Each count is one row a range, however many keys there are.
    """
    begun, rest = "", n
    while True:
        digits = len(begun) + _DIGITS
        within = keys.where(F.substring("_key", 1, len(begun)) == begun) if begun else keys
        sizes = within.groupBy(F.substring("_key", 1, digits).alias("front")).agg(F.count("*").alias("size"))
        upto = F.sum("size").over(Window.orderBy("front").rowsBetween(Window.unboundedPreceding, 0))
        border = sizes.select("front", "size", upto.alias("upto")).where(F.col("upto") >= rest).orderBy("front").first()
        if border.upto == rest or digits >= _KEY_DIGITS:
            return border.front
        begun, rest = border.front, rest - (border.upto - border["size"])


def sample_exact(df: DataFrame, n: int, seed: int = SEED, strict: bool = False) -> DataFrame:
    """``n`` rows without replacement, in random but reproducible order.

    The rows with the ``n`` smallest keys, where a row's key is a hash of the seed, of all its columns, and of its number
    among equal rows. So rows that share an id, or all their values, are drawn each by itself, and the choice does not
    depend on how the rows are laid out. Only hashes are counted and ranked; the rows meet those chosen by one join,
    equal ones once. With ``strict``, asking for more rows than there are is an error; otherwise all rows
    come back.
    """
    if n < 0:
        raise ValueError("sample size must not be negative")
    keyed = df.withColumn("_digest", row_digest(df))
    digests = materialize(keyed.groupBy("_digest").agg(F.count("*").alias("_n")), "digests")
    total = digests.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if strict and n > total:
        raise ValueError(f"cannot take {n} rows from {total} without replacement")
    chosen = _copies(digests, seed)
    if n == 0:
        chosen = chosen.limit(0)
    elif n < total:
        limit = key_limit(chosen, n)
        chosen = chosen.where(F.substring("_key", 1, len(limit)) <= limit)
    chosen = chosen.select("_digest", "_key")
    rows = keyed.join(chosen.select("_digest").distinct(), "_digest", "left_semi").dropDuplicates(["_digest"])
    return rows.join(chosen, "_digest").orderBy("_key").select(*[f"`{c}`" for c in df.columns])


def maybe_sample(df: DataFrame, n: int | None, seed: int = SEED, strict: bool = True) -> DataFrame:
    return df if n is None else sample_exact(df, n, seed, strict)

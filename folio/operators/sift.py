"""A filter of fixed size over a set of keys, ahead of a join: rows that can have no partner are not shuffled.

The filter is ``2 ** BITS`` bits in rows of ``2 ** _ROW_BITS``, 16 MB when full, whatever the set. It says no only to keys
that are not in the set; with far more keys than bits it says yes to all and the join does all the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 27
_ROW_BITS = 15  # what bitmap_construct_agg holds


def _place(keys: list[str]) -> tuple[Column, Column]:
    """Row and bit of a key."""
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << BITS))
    return F.shiftright(place, _ROW_BITS), place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def mark_members(rows: DataFrame, wanted: DataFrame, keys: list[str], out: str = "maybe") -> DataFrame:
    """Add whether a row's key may be among those of ``wanted``: false is certain, true is not."""
    row, bit = _place(keys)
    bits = wanted.select(row.alias("_row"), bit.alias("_bit")).groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, CAST(_bit & 7 AS INT)) & 1") == 1
    placed = rows.select("*", row.alias("_row"), bit.alias("_bit")).join(F.broadcast(bits), "_row", "left")
    return placed.withColumn("_byte", byte).select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(out))


def sift(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose key ``wanted`` lacks, by a scan alone."""
    return mark_members(rows, wanted, keys, "_maybe").where("_maybe").drop("_maybe")


def anti_join(rows: DataFrame, known: DataFrame, keys: list[str], join) -> DataFrame:
    """``rows`` whose key is not in ``known``, where ``join(rows, known)`` is the join that tells exactly.

    Keys of ``known`` that no row can have stay out of the join, and so do the rows that are certainly new.
    """
    known = sift(known.select(*keys), rows, keys)
    marked = mark_members(rows, known, keys, "_maybe")
    certain = marked.where(~F.col("_maybe")).drop("_maybe")
    return certain.unionByName(join(marked.where("_maybe").drop("_maybe"), known))

"""Raw catalogue files as records, each either a row or set aside as it stands.

JSON lines are read once, as VARIANT, and the columns taken from it; their types come from a statement or from the first
``PEEK_LINES`` lines. CSV is read by lines, so that a file is as many tasks as it has splits. Where quoted texts
hold line breaks, lines are joined to records by counting quotes: first by split, then along the splits of a file.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from folio.session import materialize

PEEK_LINES = 1000
_BAD = "_bad_record"
_SIMPLE_TYPES = {"STRING": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


@dataclass
class Records:
    rows: DataFrame
    bad: DataFrame  # file, record: what is no row, as it stands
    seen: Observation  # n_records and n_bad, once the rows have been read

    @classmethod
    def of(cls, parsed: DataFrame, is_bad: Column) -> Records:
        """From rows with ``_file`` and ``_record`` beside their columns."""
        seen = Observation("records")
        flagged = parsed.withColumn("_is_bad", is_bad)
        counted = flagged.observe(seen, F.count("*").alias("n_records"), F.count_if("_is_bad").alias("n_bad"))
        rows = counted.where(~F.col("_is_bad")).drop("_file", "_record", "_is_bad", _BAD)
        bad = flagged.where("_is_bad").select(F.col("_file").alias("file"), F.col("_record").alias("record"))
        return cls(rows, bad, seen)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value").alias("_record"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def _path(name: str) -> str:
    return f"$['{name}']"


def _peeked(objects: DataFrame, named: dict[str, str]) -> dict[str, str]:
    """Type of each field of the first lines; what is no plain value, or of several kinds, stays VARIANT."""
    first = objects.limit(PEEK_LINES)
    names = [r[0] for r in first.select(F.explode(F.json_object_keys("_record"))).distinct().orderBy(1).collect()]
    others = [n for n in names if n not in named and "'" not in n]
    kinds = first.agg(*[F.schema_of_variant_agg(F.try_variant_get("_all", _path(n), "variant")).alias(f"k{i}") for i, n in enumerate(others)]).first() if others else ()
    types = {n: _SIMPLE_TYPES.get(kind, "double" if str(kind).startswith("DECIMAL") else "variant") for n, kind in zip(others, kinds)}
    return {n: t for n, t in named.items() if n in names} | types


def read_json(spark: SparkSession, path: str, named: dict[str, str], schema: dict[str, str] | None = None) -> Records:
    """Records of JSON lines with the ``named`` columns that occur, and the further ones.

    With ``schema`` (types by name) the further columns are those it states and ``other``, the whole record as VARIANT;
    without, those of the first lines. An array is a named text column's value as JSON text. A line
    that is not a JSON object is a bad record.
    """
    lines = _lines(spark, path).where(F.trim("_record") != "").drop("_block")
    parsed = lines.withColumn("_all", F.try_parse_json("_record"))
    is_object = F.coalesce(F.schema_of_variant("_all").startswith("OBJECT"), F.lit(False))
    types = _peeked(parsed.where(is_object), named) if schema is None else named | schema
    columns = [F.try_variant_get("_all", _path(n), t).alias(n) for n, t in types.items()]
    other = [] if schema is None else [F.col("_all").alias("other")]
    parsed = parsed.select("_file", "_record", *columns, *other, (~is_object).alias(_BAD))
    return Records.of(parsed, F.col(_BAD))


def _odd_quotes(record: Column) -> Column:
    return (F.length(record) - F.length(F.replace(record, F.lit('"')))) % 2


def _joined(lines: DataFrame) -> DataFrame:
    """``_file, _record``: lines between which a quote is open are one record.

    Where a file's quotes do not pair up, its lines are records as they are, so no quote swallows a file.
    """
    c = F.col
    placed = materialize(lines.withColumns({"_odd": _odd_quotes(c("_record")), "_place": F.monotonically_increasing_id()}), "lines")
    file = Window.partitionBy("_file")
    before = file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("_file", "_block").agg(F.sum("_odd").alias("_odds"))
    paired = F.sum("_odds").over(file) % 2 == 0
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_odds").over(before), F.lit(0)).alias("_open"), paired.alias("_paired"))
    above = Window.partitionBy("_file", "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    met = placed.join(blocks, ["_file", "_block"])
    inside = (c("_open") + F.coalesce(F.sum("_odd").over(above), F.lit(0))) % 2 == 1
    met = materialize(met.withColumn("_begins", (~(inside & c("_paired"))).cast("long")).drop("_odd", "_open", "_paired"), "begins")
    counts = met.groupBy("_file", "_block").agg(F.sum("_begins").alias("_n"))
    counts = counts.select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
    upto = Window.partitionBy("_file", "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    numbered = met.join(counts, ["_file", "_block"]).withColumn("_number", c("_earlier") + F.sum("_begins").over(upto))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_place", "_record")))
    return numbered.groupBy("_file", "_number").agg(parts.alias("_parts")).select("_file", F.array_join("_parts._record", "\n").alias("_record"))


def read_csv(spark: SparkSession, path: str) -> Records:
    """Records of CSV files with a header and doubled quotes, all columns as text.

    The header is that of the first file; a record with more or fewer fields is a bad one.
    """
    lines = _lines(spark, path)
    broken = lines.where(_odd_quotes(F.col("_record")) == 1).limit(1).count() > 0
    records = (_joined(lines) if broken else lines.drop("_block")).where(F.trim("_record") != "")
    first = spark.read.text(path).limit(1).collect()
    header = first[0].value if first else ""
    names = next(csv.reader([header.removeprefix("﻿")]), [])
    if len(set(names)) < len(names):
        raise ValueError(f"columns named twice: {names}")
    quoted = ["`" + n.replace("`", "``") + "` STRING" for n in names]
    options = {"escape": '"', "columnNameOfCorruptRecord": _BAD, "mode": "PERMISSIVE"}
    fields = F.from_csv("_record", ", ".join([*quoted, f"{_BAD} STRING"]), options)
    parsed = records.where(F.col("_record") != header).select("_file", "_record", fields.alias("_fields"))
    return Records.of(parsed.select("_file", "_record", "_fields.*"), F.col(_BAD).isNotNull())

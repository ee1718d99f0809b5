"""Readers that report what they cannot read (F05: parse or drop, and say what was dropped).

The readers of ``readers`` fail on a field without its type, or pass over lines that hold no
record. Their checked forms here read the same formats and give good rows and rejected lines
apart, with their counts, from one scan: the parsed lines are written once to the shared scratch
folder, counted by that same job, and both parts are read from there. A rejected line is kept as
it stands in the file.

For all formats a line is rejected if it has too few or too many fields, or a field that does
not have its declared type. Blank lines are no records and are neither. Empty fields of a type
other than text are nulls, as in the failing readers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.session import measured
from rankfold.sources.readers import PEOPLE_SCHEMA, RATINGS_SCHEMA, READINGS_SCHEMA, SPEND_SCHEMA

LINE = "_line"


@dataclass
class Checked:
    rows: DataFrame
    rejected: DataFrame   # one column, ``line``
    n_rows: int
    n_rejected: int


def _parts(parsed: DataFrame, columns: list[str], name: str) -> Checked:
    """Split rows with a ``_line`` (rejected) from those without."""
    bad = F.col(LINE).isNotNull()
    stored, seen = measured(parsed, name, n_rows=F.count(F.when(~bad, 1)), n_rejected=F.count(F.when(bad, 1)))
    return Checked(stored.filter(~bad).select(*columns), stored.filter(bad).select(F.col(LINE).alias("line")), seen["n_rows"], seen["n_rejected"])


def _csv(spark: SparkSession, path: str, schema: str, keep: list[str] | None = None, **options) -> Checked:
    reader = spark.read.schema(f"{schema}, {LINE} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    for k, v in options.items():
        reader = reader.option(k, v)
    columns = keep or [c.split()[0] for c in schema.split(", ")]
    # all columns are written: fields that a scan prunes are not looked at
    return _parts(reader.csv(path), columns, "checked")


def _lines(spark: SparkSession, path: str, columns: dict[str, Column], good: Column) -> Checked:
    """Columns parsed from the text ``value``; lines that are not ``good`` are rejected."""
    text = spark.read.text(path).withColumn("value", F.make_valid_utf8(F.regexp_replace("value", r"\r\z", "")))
    text = text.filter(F.btrim("value", F.lit(" \t\f\v")) != "")
    bad = F.when(~F.coalesce(good, F.lit(False)), F.col("value")).alias(LINE)
    return _parts(text.select(*[c.alias(k) for k, c in columns.items()], bad), list(columns), "checked")


def check_ratings(spark: SparkSession, path: str, sep: str = "\t", header: bool = False) -> Checked:
    """S02-S04 with rejected lines."""
    return _csv(spark, path, RATINGS_SCHEMA, sep=sep, header=header)


def check_people(spark: SparkSession, path: str) -> Checked:
    """S08 with rejected lines."""
    return _csv(spark, path, PEOPLE_SCHEMA)


def check_readings(spark: SparkSession, path: str) -> Checked:
    """S09 with rejected lines."""
    return _csv(spark, path, READINGS_SCHEMA, keep=["station", "type", "value"])


def check_spend(spark: SparkSession, path: str) -> Checked:
    """S10 with rejected lines."""
    return _csv(spark, path, SPEND_SCHEMA, keep=["customer", "amount"])


def check_items(spark: SparkSession, path: str, sep: str = "|") -> Checked:
    """S05-S07 with rejected lines: of ``|`` and ``::`` dictionaries those without a second field or
    a numeric id, of quoted comma dictionaries those that do not have three fields or a numeric id."""
    if sep == ",":
        return _csv(spark, path, "item_id int, name string, tags string", sep=",", quote='"', escape='"')
    fields = F.split("value", re.escape(sep))
    item, name, tags = F.get(fields, F.lit(0)).try_cast("int"), F.get(fields, F.lit(1)), F.coalesce(F.get(fields, F.lit(2)), F.lit(""))
    columns = {"item_id": item, "name": name} | ({} if sep == "|" else {
        "tags": tags, "label": F.concat(name, F.lit(" <"), tags, F.lit(">"))})
    return _lines(spark, path, columns, item.isNotNull() & name.isNotNull())


def check_adjacency(spark: SparkSession, path: str) -> Checked:
    """S11 with rejected lines: those with a field that is no number."""
    parts = F.split(F.btrim("value", F.lit(" \t\f\v")), r"\s+")
    numbers = F.transform(parts, lambda x: x.try_cast("long"))
    return _lines(spark, path, {"node": F.get(numbers, F.lit(0)), "neighbours": F.slice(numbers, 2, F.greatest(F.size(numbers) - 1, F.lit(0)))},
                  ~F.exists(numbers, lambda x: x.isNull()))


def check_node_names(spark: SparkSession, path: str) -> Checked:
    """S12 with rejected lines: those without a quoted part or a numeric id."""
    fields = F.split("value", '"')
    node, name = F.trim(F.get(fields, F.lit(0))).try_cast("long"), F.get(fields, F.lit(1))
    return _lines(spark, path, {"node": node, "name": name}, node.isNotNull() & name.isNotNull())

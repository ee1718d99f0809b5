"""Readers for the delimited and line formats (S01-S13). Every reader declares its
schema, so nothing is inferred and Catalyst can prune columns and push filters into the
scan. Paths may be any Hadoop URI (local, HDFS, object store). A field that does not have
its declared type fails the read; an empty text field stays an empty text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATINGS_SCHEMA = "user_id int, item_id int, rating double, ts long"
PEOPLE_SCHEMA = "id int, name string, age int, num_friends int"
READINGS_SCHEMA = "station string, day string, type string, value double"
SPEND_SCHEMA = "customer long, item long, amount double"


def read_lines(spark: SparkSession, path: str, repair_utf8: bool = True) -> DataFrame:
    """S01 (+S13): one row per text line, column ``line``. Malformed UTF-8 is replaced
    (U+FFFD) rather than failing."""
    df = spark.read.text(path)
    line = F.make_valid_utf8("value") if repair_utf8 else F.col("value")
    return df.select(line.alias("line"))


def read_ratings(spark: SparkSession, path: str, sep: str = "\t", header: bool = False) -> DataFrame:
    """``user item rating epoch_seconds`` separated by TAB, ``::`` or comma."""
    return (spark.read.schema(RATINGS_SCHEMA).option("sep", sep).option("header", header)
            .option("mode", "FAILFAST").csv(path))


def _typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def read_items(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Item dictionaries.

    * ``|``  : ``id|name|...`` (rest unused), rows with a single field skipped;
    * ``::`` : ``id::name::tags``, plus ``label`` = ``name <tags>`` (tags empty if absent);
    * ``,``  : ``id,name,tags`` with names quoted when they hold commas, ``""`` inside quotes.
    """
    if sep == ",":
        df = (spark.read.schema("item_id string, name string, tags string")
              .option("quote", '"').option("escape", '"').option("header", False).csv(path))
        df = df.filter(F.col("name").isNotNull() | F.col("tags").isNotNull())  # a lone field is no item
        return df.select(F.col("item_id").cast("int").alias("item_id"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "tags")])
    fields = F.split(F.regexp_replace("value", r"\r\z", ""), re.escape(sep))
    df = spark.read.text(path).select(fields.alias("f")).filter(F.size("f") > 1)
    item, name = F.get("f", F.lit(0)).cast("int").alias("item_id"), F.get("f", F.lit(1)).alias("name")
    if sep == "|":
        return df.select(item, name)
    df = df.select(item, name, F.coalesce(F.get("f", F.lit(2)), F.lit("")).alias("tags"))
    return df.withColumn("label", F.concat(F.col("name"), F.lit(" <"), F.col("tags"), F.lit(">")))


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """``id,name,age,num_friends`` (CRLF or LF line ends)."""
    return _typed(spark, path, PEOPLE_SCHEMA)


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """``station,day,type,value``; the day is not used."""
    return _typed(spark, path, READINGS_SCHEMA).select("station", "type", "value")


def read_spend(spark: SparkSession, path: str) -> DataFrame:
    """``customer,item,amount``; the item is not used."""
    return _typed(spark, path, SPEND_SCHEMA).select("customer", "amount")


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``node n1 n2 ...`` split on whitespace -> ``(node, neighbours array)``.
    A node may span several lines; blank lines are dropped. White space becomes blanks first, as
    a split by a regex would compile it for every line."""
    line = reduce(lambda text, space: F.replace(text, F.lit(space), F.lit(" ")), "\t\r\f\v", F.col("value"))
    df = spark.read.text(path).select(F.trim(line).alias("line"))
    node = F.substring_index("line", " ", 1).try_cast("long")
    parts = F.array_remove(F.split("line", " "), "")
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).cast("array<long>")
    return df.select(node.alias("node"), rest.alias("neighbours")).filter(F.col("node").isNotNull())


def adjacency_entries(adjacency: DataFrame) -> DataFrame:
    """One row per listed neighbour: ``(node, neighbour)``."""
    # a plain explode adds a filter on the array's size that parses each line once more
    entries = adjacency.select("node", F.posexplode_outer("neighbours").alias("pos", "neighbour"))
    return entries.filter(F.col("pos").isNotNull()).drop("pos")


def read_node_names(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id "NAME"``; lines without a quoted part or a numeric id are dropped."""
    fields = F.split(F.col("value"), '"')
    df = spark.read.text(path).select(fields.alias("f"))
    node = F.trim(F.get(F.col("f"), 0)).try_cast("long")
    return (df.filter(F.size("f") > 1)
            .select(node.alias("node"), F.get(F.col("f"), 1).alias("name"))
            .filter(F.col("node").isNotNull()))

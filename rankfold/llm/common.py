"""Column and table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.session import scratch_path

WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_RUN = r"[\x20\x09-\x0D]+"


def ship_by_value(module: str) -> None:
    """Pickle the module's functions with the tasks, so that workers need only the public
    libraries the module uses and not this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back with its own schema.

    Cuts the lineage with a table that survives lost executors, and fixes the rows that
    later steps see."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only when the measured row count is within ``limit``; a larger table
    is joined by a shuffle. ``rows`` must come from counting ``df`` as written."""
    return F.broadcast(df) if rows <= limit else df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def space_words(text: Column) -> Column:
    """Maximal runs of characters other than space and \\x09-\\x0D; null and blank text: []."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WHITE_SPACE_RUN))


def word_count(text: Column) -> Column:
    """Number of ``space_words`` as a long."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, WHITE_SPACE_RUN))).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a column used inside a lambda would be
    computed again for every element."""
    return F.transform(F.array(value), body)[0]


def plain_words(text: Column) -> Column:
    """A-Z lowered, then maximal runs of letters a-z, digits and non-ASCII characters."""
    body = F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, " "))


def shingle_hashes(words: Column, n: int) -> Column:
    """xxhash64 of every run of ``n`` of the words."""
    def runs(w):
        first = F.sequence(F.lit(0), F.size(w) - n)
        return F.when(F.size(w) >= n, F.transform(first, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
                      ).otherwise(F.array().cast("array<bigint>"))

    return let(words, runs)

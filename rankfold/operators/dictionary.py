"""Name dictionaries kept for point lookups (J05: ``lookup(key)(0)``).

A dictionary is written once, one name per key, range-partitioned and sorted by the key, with a
Parquet bloom filter on it. A lookup names its keys as literals: footers' least and largest keys
exclude most row groups, the bloom filter those that hold none of the keys in between, and the
column index most pages of what is left. ``n`` keys read a few pages, however large the
dictionary; no join, no broadcast, no pass over the names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.functions import bounded_sort
from rankfold.operators.popularity import unique_names

ROW_GROUP_BYTES = 8 << 20
PAGE_ROWS = 2_000
DISTINCT_KEYS = 1_000_000  # that a row group's bloom filter is laid out for
MAX_KEYS = 1_000


def write_dictionary(names: DataFrame, path: str, key: str = "item_id", files: int | None = None,
                     row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS) -> str:
    """Keep ``names`` (key, name) for lookups. Null keys cannot be looked up and are left out; of
    repeated keys the smallest name is kept."""
    unique = unique_names(names.filter(F.col(key).isNotNull()).select(key, "name"), key)
    dealt = unique.repartitionByRange(files, key) if files else unique.repartitionByRange(key)
    (dealt.sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", True).option(f"parquet.bloom.filter.expected.ndv#{key}", DISTINCT_KEYS)
     .option("parquet.bloom.filter.adaptive.enabled", True)
     .option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", page_rows).parquet(path))
    return path


def lookup(dictionary: DataFrame, keys: list, key: str = "item_id") -> DataFrame:
    """The rows (key, name) of a few named keys of a stored dictionary. The keys go to the scan one
    by one: a longer IN list would only reach it as its least and largest value."""
    if len(keys) > MAX_KEYS:
        raise ValueError(f"{len(keys)} keys: join the dictionary instead")
    if not keys:
        return dictionary.limit(0)
    return dictionary.filter(reduce(or_, [F.col(key) == F.lit(k) for k in sorted(set(keys))]))


def named(top: DataFrame, dictionary: DataFrame, n: int, *order, key: str = "item_id") -> DataFrame:
    """A top-n result with ``name`` by lookup. Its at most ``n`` rows are collected, as
    their keys must be known before the dictionary is read; a key without a name gets null."""
    spark: SparkSession = top.sparkSession
    rows = top.limit(n).collect()
    keys = [r[key] for r in rows if r[key] is not None]
    names = {r[key]: r["name"] for r in lookup(dictionary, keys, key).select(key, "name").collect()}
    out = spark.createDataFrame([(*r, names.get(r[key])) for r in rows], top.schema.add("name", "string")) if rows else (
        top.limit(0).withColumn("name", F.lit(None).cast("string")))
    return bounded_sort(out, n, *order) if order else out

"""Item popularity and rating rankings.

Aggregation always happens before any name lookup, so the join sees one row per item
(or only the N rows of a top-k) instead of one row per rating. Ties are broken by the
item id everywhere so results are deterministic. Names come from a dictionary that may miss
keys or repeat them: a missing name is null, of repeated ones the smallest is taken, so a
top-n has n rows; ``unmatched_items`` counts the misses.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.functions import bounded_broadcast, bounded_sort


def item_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_ratings"))


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Rating count per item, ascending."""
    return item_counts(ratings).orderBy("n_ratings", "item_id")


def item_popularity_named(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """P10: P09 with the item name. Both sides have one row per item after the
    aggregate; Spark broadcasts the name table only when its measured size is below the
    broadcast threshold (static statistics or AQE runtime statistics)."""
    return (item_counts(ratings).join(unique_names(items), "item_id", "left")
            .select("item_id", "name", "n_ratings").orderBy("n_ratings", "item_id"))


def _top(counts: DataFrame, n: int, *order) -> DataFrame:
    # orderBy + limit plans as TakeOrderedAndProject: a per-partition top-n, then a
    # merge of at most n rows per partition.
    return counts.orderBy(*order).limit(n)


def unique_names(items: DataFrame, key: str = "item_id") -> DataFrame:
    """One name per key."""
    return items.groupBy(key).agg(F.min("name").alias("name"))


def with_names(top: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Add ``name`` to a top-n result of different keys. One join with the
    dictionary, and a smallest name for each of the few rows; a row that the join misses keeps null."""
    found = items.select(F.col(key).alias("_rf_key"), "name").join(bounded_broadcast(top), F.col("_rf_key") == F.col(key))
    missed = top.withColumn("name", F.lit(None).cast(items.schema["name"].dataType))
    return found.select(*top.columns, "name").unionByName(missed).groupBy(*top.columns).agg(F.min("name").alias("name"))


def unmatched_items(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """One row: rated items that the dictionary does not hold, and their ratings."""
    missing = item_counts(ratings).join(items.select("item_id"), "item_id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("n_items"), F.coalesce(F.sum("n_ratings"), F.lit(0)).alias("n_ratings"))


def _named(top: DataFrame, items: DataFrame, n: int, cols: list[str], *order) -> DataFrame:
    return bounded_sort(with_names(top, items).select(*cols), n, *order)


def top_items(ratings: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The n most rated items with names."""
    order = (F.col("n_ratings").desc(), F.col("item_id").asc())
    top = _top(item_counts(ratings), n, *order)
    return _named(top, items, n, ["item_id", "name", "n_ratings"], *order)


def bottom_items(ratings: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The n least rated items with names."""
    order = (F.col("n_ratings").asc(), F.col("item_id").asc())
    top = _top(item_counts(ratings), n, *order)
    return _named(top, items, n, ["item_id", "name", "n_ratings"], *order)


def rating_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.avg("rating").alias("avg_rating"),
                                          F.count(F.lit(1)).alias("n_ratings"))


def top_rated_items(ratings: DataFrame, items: DataFrame, min_count: int, n: int = 10) -> DataFrame:
    """Best mean rating among items with more than ``min_count`` ratings."""
    order = (F.col("avg_rating").desc(), F.col("item_id").asc())
    stats = rating_stats(ratings).filter(F.col("n_ratings") > min_count)
    top = _top(stats, n, *order)
    return _named(top.withColumn("avg_rating", F.round("avg_rating", 6)), items, n,
                  ["item_id", "name", "avg_rating", "n_ratings"], *order)


def tag_list(tags_col: str = "tags", sep: str = "|"):
    return F.split(F.col(tags_col), re.escape(sep))


def items_with_tag(items: DataFrame, tag: str, sep: str = "|") -> DataFrame:
    """Items whose tag list holds ``tag`` as a whole element (not a substring)."""
    return items.filter(F.array_contains(tag_list("tags", sep), tag))


def top_rated_items_in_tag(ratings: DataFrame, items: DataFrame, tag: str, min_count: int,
                           n: int = 10, sep: str = "|") -> DataFrame:
    """P13 restricted to items carrying ``tag``; the semi join runs before the
    aggregate so only ratings of tagged items are shuffled."""
    tagged = items_with_tag(items, tag, sep).select("item_id")
    return top_rated_items(ratings.join(tagged, "item_id", "left_semi"), items, min_count, n)

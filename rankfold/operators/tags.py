"""Tag (genre) reports over multi-valued item attributes.

Ratings are first reduced to one count per item; only that small per-item table meets
the item dictionary and the tag explode. Ranked lists are numbered with a distributed
ordinal rather than a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.functions import ordinal
from rankfold.operators.popularity import item_counts, tag_list


def rating_tag_pairs(ratings: DataFrame, items: DataFrame, sep: str = "|", n: int | None = None) -> DataFrame:
    """One row per (rating, tag of the rated item), or the first ``n`` of them by rating,
    highest first, then tag. Items missing from the dictionary have no tags and produce no
    row (``popularity.unmatched_items`` counts them)."""
    tagged = items.select("item_id", F.explode(tag_list("tags", sep)).alias("tag"))
    pairs = ratings.select("item_id", "rating").join(tagged, "item_id").select("rating", "tag")
    return pairs if n is None else pairs.orderBy(F.col("rating").desc(), "tag").limit(n)


def tag_rating_totals(ratings: DataFrame, items: DataFrame, sep: str = "|") -> DataFrame:
    per_item = item_counts(ratings)
    exploded = (items.select("item_id", F.explode(tag_list("tags", sep)).alias("tag"))
                .join(per_item, "item_id"))
    return exploded.groupBy("tag").agg(F.sum("n_ratings").alias("n_ratings"))


def tag_item_totals(items: DataFrame, sep: str = "|") -> DataFrame:
    return (items.select(F.explode(tag_list("tags", sep)).alias("tag"))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n_items")))


def tag_rating_counts(ratings: DataFrame, items: DataFrame, sep: str = "|") -> DataFrame:
    """Tags ranked by number of ratings."""
    totals = tag_rating_totals(ratings, items, sep)
    return ordinal(totals, [F.col("n_ratings").desc(), F.col("tag").asc()])  # in rank order


def tag_item_counts(items: DataFrame, sep: str = "|") -> DataFrame:
    """Tags ranked by number of catalogue items."""
    totals = tag_item_totals(items, sep)
    return ordinal(totals, [F.col("n_items").desc(), F.col("tag").asc()])  # in rank order


def tag_popularity(ratings: DataFrame, items: DataFrame, sep: str = "|") -> DataFrame:
    """Rank, tag, ratings, items, ratings div items; descending by ratings."""
    joined = (tag_rating_totals(ratings, items, sep).join(tag_item_totals(items, sep), "tag")
              .withColumn("ratio", F.expr("n_ratings div n_items")))
    ranked = ordinal(joined, [F.col("n_ratings").desc(), F.col("tag").asc()])
    return ranked.select("rank", "tag", "n_ratings", "n_items", "ratio")  # in rank order

"""Word counts over text lines.

Tokens come from ``explode`` of a split; the count is a partial (map-side) aggregate, so
a word holding a large share of all tokens costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.functions import java_split

# Stop words removed by the sorted word count, as in the reference.
STOP_WORDS = ("is", "am", "are", "a", "the", "an", "and", "it", "of", "for", "on", "in", "or", "to")

SPACE = " "
NON_WORD = r"\W+"


def tokens(lines: DataFrame, pattern: str, lower: bool = False, line_col: str = "line") -> DataFrame:
    word = F.explode(java_split(line_col, pattern)).alias("word")
    out = lines.select(word)
    return out.select(F.lower("word").alias("word")) if lower else out


def word_count(lines: DataFrame, pattern: str = SPACE, lower: bool = False,
               stop_words: tuple[str, ...] | None = None, sort: bool = False,
               line_col: str = "line") -> DataFrame:
    """P02 (space split), P03 (``\\W+`` split, lower-cased), P04 (+ stop words, sorted)."""
    words = tokens(lines, pattern, lower, line_col)
    if stop_words:
        words = words.filter(~F.col("word").isin(list(stop_words)))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if sort:
        counts = counts.orderBy(F.col("n").desc(), F.col("word").asc())
    return counts

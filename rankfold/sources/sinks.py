"""Writers for reports (K01-K03). Output goes to a folder of part files written in
parallel; a globally sorted DataFrame produces part files in sort order, so no
single-task ``coalesce(1)`` is needed. ``write_tag_report_file`` gives the one ranked file for
reports whose counted rows are within a stated bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG_REPORT_SCHEMA = "rank long, tag string, n_ratings long, n_items long, ratio long"


def write_tag_report(report: DataFrame, path: str) -> str:
    """``rank,tag,ratings,items,ratio`` lines in rank order."""
    # a report of ``tags.tag_popularity`` comes in rank order
    (report.select("rank", "tag", "n_ratings", "n_items", "ratio")
     .write.mode("overwrite").option("header", False).csv(path))
    return path


def write_tag_report_file(report: DataFrame, path: str, max_rows: int = 1_000_000) -> str:
    """K01 as one file in rank order. ``path`` becomes a folder with a single part file. The rows are
    counted first; a report of more than ``max_rows`` is refused, since one task would write it
    (``write_tag_report`` has no such bound). An empty report gives an empty file or none."""
    rows = report.select("rank", "tag", "n_ratings", "n_items", "ratio").persist()
    try:
        n = rows.count()
        if n > max_rows:
            raise ValueError(f"{n} rows for one file, more than {max_rows}: use write_tag_report")
        (rows.repartition(1).sortWithinPartitions("rank")
         .write.mode("overwrite").option("header", False).csv(path))
    finally:
        rows.unpersist()
    return path


def read_tag_report(spark, path: str) -> DataFrame:
    return spark.read.schema(TAG_REPORT_SCHEMA).csv(path)


def write_similarities(sims: DataFrame, path: str, fmt: str = "parquet") -> str:
    """The pair table sorted by (item1, item2), as parquet or as text lines
    ``(item1,item2)<TAB>(score,n_pairs)`` with six decimals."""
    ordered = sims.orderBy("item1", "item2")
    if fmt == "text":
        line = F.format_string("(%d,%d)\t(%.6f,%d)", "item1", "item2", "score", "n_pairs")
        ordered.select(line.alias("value")).write.mode("overwrite").text(path)
    else:
        ordered.write.mode("overwrite").parquet(path)
    return path


def format_lines(df: DataFrame, template: str, *cols) -> DataFrame:
    """One formatted text line per row (``format_string``, printf-style)."""
    return df.select(F.format_string(template, *cols).alias("line"))


def write_lines(lines: DataFrame, path: str) -> str:
    lines.select(F.col("line").alias("value")).write.mode("overwrite").text(path)
    return path

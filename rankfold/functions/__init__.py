"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM-side, codegen'd)."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_BREAK = r"\r\n|\r|\n"


def java_split(col: Column | str, pattern: str) -> Column:
    """Split like ``java.lang.String.split(regex)``.

    Leading empty tokens are kept, trailing ones dropped; an empty string gives ``[""]``
    and a string made only of delimiters gives ``[]``. Spark's ``split`` keeps trailing
    empties; they are cut from the array, so a run of delimiters costs linear time."""
    c = F.col(col) if isinstance(col, str) else col
    if pattern == " ":  # the trailing run is cut before it becomes tokens
        body = F.rtrim(c)
        return F.when((c != "") & (body == ""), F.array().cast("array<string>")).otherwise(F.split(body, pattern))
    parts = F.split(c, pattern)
    filled = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when((c == "") | (F.element_at(parts, -1) != ""), parts).otherwise(F.slice(parts, 1, filled))


def text_lines(col: Column | str) -> Column:
    """Array of lines as a line reader would return them (one final terminator ignored)."""
    c = F.col(col) if isinstance(col, str) else col
    body = F.regexp_replace(c, f"(?:{LINE_BREAK})\\z", "")
    return F.when(c == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


EPOCH = "1970-01-01 00:00:00"


def epoch_seconds(df: DataFrame, ts: str = "ts") -> Column:
    """Whole seconds since 1970-01-01 of ``df``'s column ``ts``: a timestamp, or an integer
    that holds epoch seconds already (as the ratings readers give)."""
    if isinstance(df.schema[ts].dataType, T.IntegralType):
        return F.col(ts).cast("bigint")
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts))


def latest_first_key(df: DataFrame, ts: str = "ts", tiebreak: str | None = "event_id") -> Column:
    """One exact DECIMAL(38,0) ordering key for (ts, tiebreak): time * 2^64 +
    (tiebreak + 2^63). Unlike a struct, a decimal maximum runs in a hash aggregate. Time is
    in microseconds for a timestamp and as it stands for an integer."""
    d = "decimal(38,0)"
    time = (F.col(ts) if isinstance(df.schema[ts].dataType, T.IntegralType)
            else F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts)))
    last = F.col(tiebreak).cast(d) if tiebreak else F.lit(0).cast(d)
    return time.cast(d) * F.lit(Decimal(2 ** 64)).cast(d) + (last + F.lit(Decimal(2 ** 63)).cast(d))


def latest_per_key(df: DataFrame, keys: list[str], values: list[str], ts: str = "ts",
                   tiebreak: str | None = "event_id") -> DataFrame:
    """The row with the latest ``ts`` per key (ties: largest ``tiebreak``; without that
    column the largest values), as a partial (map-side) hash aggregate: a hot key is
    combined before the shuffle instead of being sorted inside one task as a window would do."""
    others = [v for v in values if v != ts]
    if tiebreak is None or tiebreak not in df.columns:
        # tied rows: the largest values together, so they stay one row
        best = F.max(F.struct(F.col(ts), *others)).alias("_rf_best")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_rf_best.{v}").alias(v) for v in [*others, ts]])
    key = latest_first_key(df, ts, tiebreak)
    aggs = [F.max_by(v, key).alias(v) for v in others] + [F.max_by(ts, key).alias(ts)]
    latest = df.groupBy(*keys).agg(*aggs, F.max(key).alias("_rf_key"))
    tb = (F.pmod(F.col("_rf_key"), F.lit(Decimal(2 ** 64))) - F.lit(Decimal(2 ** 63))).cast("long")
    return latest.withColumn(tiebreak, tb).drop("_rf_key")


def hash_below(key: Column | str, seed: int, fraction: float) -> Column:
    """True for about ``fraction`` of the keys: the first 32 bits of md5 of ``key:seed``
    against ``fraction * 2^32``; independent of order and partitions."""
    c = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < F.lit(int(round(fraction * 2 ** 32)))


def literal_rows(spark, columns: list[tuple[str, str]], rows: list[tuple]) -> DataFrame:
    """A small result built JVM-side from driver scalars (no Python rows to deserialize).
    ``columns`` are (name, Spark SQL type) pairs."""
    def one(values):
        return spark.range(1).select(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(columns, values)])
    if not rows:
        return one([None] * len(columns)).limit(0)
    out = one(rows[0])
    for r in rows[1:]:
        out = out.unionByName(one(r))
    return out


BYTES_PER_SPLIT = 4 << 20  # Spark cuts scans no finer (spark.sql.files.openCostInBytes)


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan over the cluster if its files are too small to give every core a split.

    CPU-heavy per-row work (regex tokenizing) otherwise runs in as many tasks as the scan
    has splits. Call it on the scan itself: the decision uses the optimizer's size of the
    files, so no job runs, and a large input is not shuffled."""
    if scan.isStreaming:
        return scan
    slots = scan.sparkSession.sparkContext.defaultParallelism
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return scan.repartition(slots) if size < slots * BYTES_PER_SPLIT * 8 else scan


def proven_rows(df: DataFrame) -> int | None:
    """The most rows that the optimizer proves ``df`` can have (a limit, a global aggregate,
    literal rows), None if it proves no bound. No job runs."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Hint a broadcast of ``df`` only if its proven rows, at the width of its columns, fit the
    session's ``spark.sql.autoBroadcastJoinThreshold``. Otherwise Spark chooses the join from
    the sizes it measures."""
    rows = proven_rows(df)
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if rows is not None and rows * df._jdf.schema().defaultSize() <= threshold else df


def bounded_sort(df: DataFrame, max_rows: int, *order) -> DataFrame:
    """Final ordering of a result bounded by construction (a top-n): a limit of the same bound
    lets Spark sort in each partition and merge at most ``max_rows`` rows of each, without a range
    exchange and its sampling job."""
    return df.orderBy(*order).limit(max_rows)


def ordinal(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Attach 1-based positions of a total order without moving all rows to one task.

    The rows are range-partitioned and sorted, tagged with their position inside the
    partition, and checkpointed (reliable, in the shared folder) so every later use sees
    the same partitioning. The row count of each partition (one value per partition,
    bounded by the partition count) gives each partition's offset; the offsets enter the
    plan as a literal array indexed by partition, so no join or window is needed."""
    from rankfold.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    # persisted so the checkpoint write reads the sorted rows instead of sorting again
    sorted_rows = df.orderBy(*order).withColumn("_rf_mid", F.monotonically_increasing_id()).persist()
    tagged = sorted_rows.checkpoint(eager=True)
    sorted_rows.unpersist()
    part = F.shiftright(F.col("_rf_mid"), 33)
    sizes = {int(r[0]): int(r[1]) for r in tagged.groupBy(part).count().collect()}
    offsets, running = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(running)
        running += sizes.get(p, 0)
    # one literal whatever the number of partitions
    known = F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")
    offset = F.element_at(known, (part + 1).cast("int")) if offsets else F.lit(0)
    within = F.col("_rf_mid") - F.shiftleft(part, 33)
    return (tagged.withColumn(name, (offset + within + 1).cast("bigint"))
            .drop("_rf_mid"))

"""Mix sources to target weights with hash-threshold histograms.

Every document has a fixed pseudo-random hash. A source whose target is ``q`` whole copies
plus a remainder takes every document ``q`` times and once more the documents whose hash is
below the source's threshold. Thresholds come from histograms: sizes are summed by (source,
leading hash bits), the bucket in which the running sum passes the remainder is the boundary
bucket, and only rows of boundary buckets are summed again by the next bits, until a boundary
bucket holds a single hash value. Nothing is sorted by hash and no source is gathered in one
task: a histogram has at most ``2**BITS`` rows for each source after a map-side sum.

A smaller remainder gives a smaller threshold over the same hashes, so samples for smaller
budgets are nested in those for larger ones.

Nulls: a null text has size 0; a null source is a source of its own, last in order; a null
``doc_id`` is hashed like any value. Repeated rows have equal hashes and are decided
together. Sources of size 0 have target 0. An empty table gives an empty result. Columns
other than ``doc_id``, ``text`` and ``source`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.functions import ordinal
from rankfold.llm.common import word_count, written

HASH_BITS = 60
BITS = 12
BROADCAST_SOURCES = 100_000
SALTS = 64


def hash60(seed: int = 0):
    """The first 60 bits of md5(doc_id:seed:text) as a long."""
    text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed)),
                       F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def attach(rows: DataFrame, per_source: DataFrame, sources: int, salt: str = "h") -> DataFrame:
    """Join ``per_source`` (one row per source, null included) to ``rows``: broadcast when its
    counted rows are few, else over sources salted by the hash column ``salt``, so a hot
    source is dealt to many tasks."""
    right = per_source.withColumnRenamed("source", "_mx_source")
    same = F.col("source").eqNullSafe(F.col("_mx_source"))
    if sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(right), same).drop("_mx_source")
    left = rows.withColumn("_mx_salt", F.pmod(F.col(salt), F.lit(SALTS)))
    right = right.withColumn("_mx_salt2", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, same & (F.col("_mx_salt") == F.col("_mx_salt2"))).drop("_mx_source", "_mx_salt", "_mx_salt2")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3,
                   budget: float = 1.0) -> DataFrame:
    """(source, source_size, target) from one row per source. The weights repeat over the
    sources in code point order, null last. A target stops at ``max_repeat`` times its
    source's size; what is left is shared by weight among the others until none is above."""
    ranked = ordinal(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    src = written(ranked.select("source", "source_size", weight.cast("long").alias("weight"),
                                (F.col("source_size") * max_repeat).alias("most")), "mix-sources")
    total = (src.agg(F.sum("source_size")).first()[0] or 0) * budget
    share, full = 0.0, -1
    while True:  # the set of full sources only grows; a few scalars a round reach the driver
        above = F.lit(full >= 0) & (F.col("weight") * F.lit(share) > F.col("most"))
        r = src.agg(F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)), F.count(F.when(above, 1)),
                    F.sum(F.when(~above, F.col("weight")))).first()
        if int(r[1]) == full or not r[2]:
            break
        full, share = int(r[1]), (total - int(r[0])) / int(r[2])
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(float(share)))
    return src.select("source", "source_size", target.alias("target"))


def thresholds(base: DataFrame, targets: DataFrame, sources: int, bits: int = BITS) -> DataFrame:
    """(source, source_size, target, copies, below): each document counts ``copies`` times,
    and once more if its ``h`` is less than ``below``. ``base`` has source, h and size."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = (targets.withColumn("copies", whole)
             .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
             .withColumn("prefix", F.lit(0).cast("long")).withColumn("under", F.lit(0).cast("long"))
             .withColumn("below", F.when(F.col("rest") <= 0, F.lit(0).cast("long"))))
    state, left = written(state, "mix-state"), HASH_BITS
    while left and not (open_ := state.filter("below IS NULL")).isEmpty():
        width, right = min(bits, left), left - min(bits, left)
        inside = attach(base, open_.select("source", "rest", "prefix", "under"), sources).filter(
            F.shiftright("h", left) == F.col("prefix"))
        hist = (inside.groupBy("source", "rest", "under", F.shiftright("h", right).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("h0"), F.max("h").alias("h1")))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edge = (hist.withColumn("upto", F.col("under") + F.sum("words").over(run)).filter(F.col("upto") > F.col("rest"))
                .groupBy("source", "rest").agg(F.min_by(F.struct("bucket", "words", "h0", "h1", "upto"), "bucket").alias("e"))
                .select("source", "rest", "e.*").withColumn("before", F.col("upto") - F.col("words")))
        # one hash value left: take it if that comes nearer to the target
        last = F.when(F.col("upto") - F.col("rest") < F.col("rest") - F.col("before"), F.col("h1") + 1).otherwise(F.col("h0"))
        edge = edge.select("source", F.col("bucket").alias("b"), "before", F.when(F.col("h0") == F.col("h1"), last).alias("cut"))
        edge = edge.withColumnRenamed("source", "_mx_source")
        new = (open_.drop("below").join(edge, F.col("source").eqNullSafe(F.col("_mx_source")), "left")
               # no boundary: the remainder covers every document
               .withColumn("below", F.when(F.col("b").isNull(), F.lit(1 << HASH_BITS)).otherwise(F.col("cut")))
               .withColumn("prefix", F.coalesce("b", "prefix")).withColumn("under", F.coalesce("before", "under"))
               .select(*state.columns))
        state, left = written(state.filter("below IS NOT NULL").unionByName(new), "mix-state"), right
    return state.select("source", "source_size", "target", "copies", "below")


def mixture(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, budget: float = 1.0,
            seed: int = 0, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, source, size, h, source_size, target, times (how often
    the mix takes it) and taken = size * times."""
    base = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash60(seed).alias("h")), "mix-base")
    sizes = written(base.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    sources = sizes.count()
    cuts = thresholds(base, source_targets(sizes, weights, max_repeat, budget), sources, bits)
    times = F.col("copies") + (F.col("h") < F.col("below")).cast("long")
    return (attach(base, cuts, sources).withColumn("times", times)
            .select("doc_id", "source", "size", "h", "source_size", "target", "times",
                    (F.col("size") * F.col("times")).alias("taken")))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, budget: float = 1.0,
               seed: int = 0, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as it is taken."""
    base = written(docs.select("source", word_count(F.col("text")).alias("size"), hash60(seed).alias("h")), "mix-base")
    sizes = written(base.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    sources = sizes.count()
    cuts = (thresholds(base, source_targets(sizes, weights, max_repeat, budget), sources, bits)
            .select("source", F.col("copies").alias("_mx_copies"), F.col("below").alias("_mx_below")))
    rows = attach(docs.withColumn("_mx_h", hash60(seed)), cuts, sources, "_mx_h")
    times = (F.col("_mx_copies") + (F.col("_mx_h") < F.col("_mx_below")).cast("long")).cast("int")
    return (rows.withColumn("_mx_times", times).filter("_mx_times > 0")
            .withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), F.col("_mx_times")))).select(*docs.columns))


# The registered query: weights 1, 2, 3, at most three times each source, seed 0.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':0:' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
c AS (SELECT *, 3 * source_size AS most,
  coalesce(sum(3 * source_size) OVER w, 0) AS full_size, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight,
  sum(source_size) OVER () AS total FROM s
  WINDOW w AS (ORDER BY 3 * source_size / weight, weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT min_by((total - full_size)::DOUBLE / open_weight::DOUBLE, full_size) AS share
  FROM c WHERE weight * ((total - full_size)::DOUBLE / open_weight::DOUBLE) <= most),
t AS (SELECT source, source_size, least(most::DOUBLE, weight * share) AS target FROM c, share),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
u AS (SELECT g.*, r.target - r.copies * r.source_size AS rest, sum(words) OVER (PARTITION BY g.source ORDER BY h) AS upto
  FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source),
b AS (SELECT source, min_by(CASE WHEN upto - rest < rest - (upto - words) THEN h + 1 ELSE h END, h) AS below FROM u WHERE upto > rest GROUP BY source)
SELECT doc_id, size, r.source_size, r.target,
  size * (r.copies + (r.target - r.copies * r.source_size > 0 AND h < coalesce(b.below, 1152921504606846976))::BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""

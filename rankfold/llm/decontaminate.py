"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is short and a document may be very long, so the Jaccard similarity of the
two says little; what counts is the share of the item's word shingles that the document
holds. Items are partitioned by the size of their shingle set (powers of two). Every item is
represented by the smallest hashes of its shingles (a bottom-k MinHash sketch) whose length
``k`` follows from its partition: at a containment of ``threshold`` or more at most
``missing`` shingles can be absent, and with ``k`` above that some of the sketch must occur
in the document. So no pair is lost, whatever the document's length. Documents' shingle
hashes are streamed against the sketches (one equi-join on the hash, no shuffle of texts
while the sketches fit the checked broadcast bound), and candidates are verified by exact
containment of the shingles themselves.

Texts are compared in A-Z-lowered words of letters, digits and non-ASCII characters. An item
of fewer than five words is one shingle of all its words. Items and documents without words
match nothing. Nulls: a null text has no words; a null id is an id like any other. Repeated
rows give one pair. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import broadcast_if_small, let, plain_words, shingle_hashes, written

SHINGLE = 5
THRESHOLD = 0.8
EXTRA = 2  # sketch hashes beyond those that may be missing; so many must be found
BROADCAST_SKETCH = 2_000_000
BROADCAST_PAIRS = 200_000
BROADCAST_ITEMS = 10_000


def _at_least(n, threshold: float):
    """Smallest count of ``n`` shingles that reaches the threshold."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9))


def sketches(items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """One row per item with words: item_id, words, len (words in a shingle), n (distinct
    shingles), partition (log2 of the largest set in it), sketch (smallest hashes) and need
    (sketch hashes that a containing document must hold)."""
    words = items.select("item_id", plain_words(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
    size = F.size("words")
    hashes = F.lit(None).cast("array<bigint>")
    for m in range(1, shingle + 1):
        kind = size == m if m < shingle else size >= m
        hashes = F.when(kind, shingle_hashes(F.col("words"), m)).otherwise(hashes)
    out = words.withColumn("len", F.least(size, F.lit(shingle))).withColumn("hashes", F.sort_array(F.array_distinct(hashes)))
    out = out.withColumn("n", F.size("hashes")).withColumn("partition", F.ceil(F.log2("n")).cast("int"))
    top = F.pow(F.lit(2), F.col("partition"))
    k = F.least(F.col("n"), F.floor(top - _at_least(top, threshold)) + EXTRA)
    out = out.withColumn("k", k.cast("int"))
    missing = F.col("n") - _at_least(F.col("n"), threshold)
    return out.select("item_id", "words", "len", "n", "partition", F.slice("hashes", 1, F.col("k")).alias("sketch"),
                      (F.col("k") - missing).alias("need"))


def candidates(docs: DataFrame, sketch: DataFrame) -> DataFrame | None:
    """(doc_id, text_hash, item_id) that share enough of the sketch; None without sketches."""
    rows = sketch.select("item_id", "len", "n", "need", F.explode("sketch").alias("hash"))
    lengths = sorted(r[0] for r in sketch.select("len").distinct().collect())  # at most five values
    many = rows.count()
    found = None
    for m in lengths:
        side = broadcast_if_small(rows.filter(F.col("len") == m).drop("len"), many, BROADCAST_SKETCH)
        hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                             F.explode(shingle_hashes(plain_words(F.col("text")), m)).alias("hash"))
        hits = hashed.join(side, "hash")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return None
    return (found.groupBy("doc_id", "text_hash", "item_id", "need").agg(F.count_distinct("hash").alias("hits"))
            .filter("hits >= need").select("doc_id", "text_hash", "item_id").distinct())


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment, text_hash) of each document and
    item of whose distinct shingles the document holds the share ``threshold`` or more."""
    docs = docs.select("doc_id", "text")
    sketch = written(sketches(items.select("item_id", "text"), threshold, shingle), "decon-sketch")
    pairs = candidates(docs, sketch)
    if pairs is None:
        none = F.lit(None).cast(items.schema["item_id"].dataType)
        pairs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), none.alias("item_id")).limit(0)
    pairs = written(pairs, "decon-pairs")
    few = pairs.count()
    names = pairs.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "item_id")
    full = sketch.select(F.col("item_id").alias("_i"), F.col("words").alias("item_words"), "len")
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    both = texts.join(broadcast_if_small(names, few, BROADCAST_PAIRS),
                      (F.col("text_hash") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    both = both.join(broadcast_if_small(full, sketch.count(), BROADCAST_ITEMS), F.col("item_id").eqNullSafe(F.col("_i")))

    def shingles(words, n):
        first = F.sequence(F.lit(1), F.size(words) - n + 1)
        return F.when(F.size(words) >= n, F.array_distinct(F.transform(first, lambda i: F.concat_ws(" ", F.slice(words, i, n))))
                      ).otherwise(F.array().cast("array<string>"))

    both = both.select("doc_id", "text_hash", "item_id", "item_words", "len", plain_words(F.col("text")).alias("words"))
    counted = both.select(
        "doc_id", "text_hash", "item_id",
        let(F.struct("item_words", "words", "len"), lambda r: let(
            shingles(r["item_words"], r["len"]),
            lambda s: F.struct(F.size(F.array_intersect(s, shingles(r["words"], r["len"]))).cast("long").alias("n_shared"),
                               F.size(s).cast("long").alias("n_shingles")))).alias("c"))
    share = F.col("n_shared") / F.col("n_shingles")
    return (counted.select("doc_id", "item_id", "c.n_shared", "c.n_shingles", "text_hash").withColumn("containment", share)
            .filter(F.col("n_shared") >= _at_least(F.col("n_shingles"), threshold)).distinct())


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    found = written(contained_items(docs, items, threshold, shingle)
                    .select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct(), "decon-found")
    gone = broadcast_if_small(found, found.count(), BROADCAST_PAIRS * 5)
    return (docs.withColumn("_dc_hash", F.xxhash64("text"))
            .join(gone, (F.col("_dc_hash") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left_anti")
            .select(*docs.columns))


def _words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


ORACLE_SQL = rf"""
WITH item AS (SELECT item_id, w, least(len(w), {SHINGLE}) AS k FROM (SELECT item_id, {_words_sql('text')} AS w FROM benchmark) WHERE len(w) > 0),
item_sh AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS s FROM item),
item_n AS (SELECT item_id, k, count(*) AS n_shingles FROM item_sh GROUP BY ALL),
doc AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents WHERE text IS NOT NULL),
doc_sh AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS s
           FROM doc, (SELECT DISTINCT k FROM item)),
both_sh AS (SELECT doc_id, item_id, count(*) AS n_shared FROM doc_sh JOIN item_sh USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM both_sh JOIN item_n USING (item_id) WHERE n_shared >= ceil(n_shingles * {THRESHOLD} - 1e-9)
"""

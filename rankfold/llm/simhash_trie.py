"""SimHash near-duplicates by a binary-trie self-join.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints within
``max_bits`` differing bits are linked by walking pairs of trie nodes down from the root:
a pair carries the bits in which the two prefixes differ and is dropped as soon as that
passes the budget. Documents of one linked component are one group.

Three tries share the work. Trie t starts at the t-th third of the bits; two fingerprints
that differ in at most 4 bits differ in at most one bit of some third, so each trie needs a
budget of only ``max_bits // 3`` in its leading third (and ``max_bits`` in all), which prunes
most node pairs. Spark cuts each trie at a prefix depth chosen from the number of distinct
fingerprints: a row goes to its own subtrie and, as a partner, to the smaller subtries whose
prefix is within the leading budget. One subtrie with more rows than ``MAX_CELL`` is dealt
over block pairs so no task holds an unbounded group. Inside a task a subtrie pair is
walked in numpy with a bounded frontier, and only a spanning forest of the links leaves the
task, so a dense cluster never emits all its pairs. (Every link is still examined or is
between fingerprints that are already connected.)

Nulls: a null text is an empty text (fingerprint zero, linked like any other). A null
``doc_id`` counts for links but never names a component, unless all ids of it are null.
Repeated rows each get their row. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import ship_by_value, written
from rankfold.llm.components import connected_components

ship_by_value(__name__)

SEED = 42
THIRDS = (0, 22, 43)  # first bit of each third
LEADING = 21  # bits of the shortest third
SALTS = 32
MAX_CELL = 20_000
FRONTIER = 200_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the A-Z-lowered, space-joined word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = [digest(join(words[i:i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))]
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i:i + 65_536], dtype="<u8")
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) per row; ``fp`` is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def _rotated(fp: Column, k: int) -> Column:
    if k == 0:
        return fp
    return F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k))


def prefix_depth(n: int) -> int:
    """Trie depth at which subtries hold about 2,000 of ``n`` fingerprints."""
    return min(LEADING, max(4, math.ceil(math.log2(max(n, 1) / 2048 + 1))))


def walk(values: np.ndarray, depth: int, own: int, max_bits: int, lead_bits: int, lead: int) -> np.ndarray:
    """Walk node pairs of one subtrie. ``values``: sorted distinct rotated fingerprints of
    which those with prefix ``own`` are paired with all others. Returns the index of each
    value's root in a spanning forest of the links."""
    n = len(values)
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def flatten() -> None:
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up

    def prefix_start(prefix: np.ndarray) -> np.ndarray:
        return np.searchsorted(values, prefix << np.uint64(64 - depth), "left")

    prefixes, starts = np.unique(values >> np.uint64(64 - depth), return_index=True)
    ends = np.append(starts[1:], n)
    mine = np.flatnonzero(prefixes == np.uint64(own))
    if not len(mine):
        return parent
    diff = np.bitwise_count(prefixes ^ np.uint64(own)).astype(np.int64)
    near = np.flatnonzero(diff <= lead_bits)
    a0 = np.full(len(near), starts[mine[0]])
    a1 = np.full(len(near), ends[mine[0]])
    stack = [(depth, a0, a1, starts[near], ends[near], diff[near])]
    changes = np.zeros(n, dtype=np.int64)  # labels that change between neighbours, summed
    steps_since = 0
    while stack:
        d, al, ah, bl, bh, diff = stack.pop()
        # both nodes lie in one component already: their links join nothing new
        same = (changes[ah - 1] == changes[al]) & (changes[bh - 1] == changes[bl]) & (parent[al] == parent[bl]) if steps_since else np.zeros(len(al), bool)
        single = (al == bl) & (ah - al == 1)
        keep = ~(same | single)
        al, ah, bl, bh, diff = (x[keep] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        if len(al) > FRONTIER:
            for i in range(0, len(al), FRONTIER):
                stack.append((d, *(x[i:i + FRONTIER] for x in (al, ah, bl, bh, diff))))
            continue
        sizes = (ah - al) * (bh - bl)
        leaf = (sizes <= 8) | (d >= 64)
        if leaf.any():
            li = np.flatnonzero(leaf)
            count = sizes[li]
            which = np.repeat(li, count)
            at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            width = (bh - bl)[which]
            i, j = al[which] + at // width, bl[which] + at % width
            # the walked bits are summed already; the leaves add what is left below
            x = values[i] ^ values[j]
            head = np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(64 - lead)
            ok = (i != j) & (np.bitwise_count(x) <= max_bits) & (np.bitwise_count(x & head) <= lead_bits)
            i, j = i[ok], j[ok]
            new = parent[i] != parent[j]
            if new.any():
                for p, q in np.unique(np.stack([parent[i[new]], parent[j[new]]], axis=1), axis=0):
                    p, q = find(p), find(q)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                flatten()
                changes = np.append(0, np.cumsum(parent[1:] != parent[:-1]))
                steps_since = 1
            al, ah, bl, bh, diff = (x[~leaf] for x in (al, ah, bl, bh, diff))
            if not len(al):
                continue
        bit = np.uint64(63 - d)

        def middle(lo, hi, bit=bit):
            edge = ((values[lo] >> bit) | np.uint64(1)) << bit
            return np.clip(np.searchsorted(values, edge, "left"), lo, hi)

        am, bm = middle(al, ah), middle(bl, bh)
        twin = (al == bl) & (ah == bh)
        children = [(al, am, bl, bm, diff, None), (am, ah, bm, bh, diff, None),
                    (al, am, bm, bh, diff + 1, None), (am, ah, bl, bm, diff + 1, ~twin)]
        budget = lead_bits if d + 1 <= lead else max_bits
        out = []
        for x0, x1, y0, y1, dd, also in children:
            ok = (x1 > x0) & (y1 > y0) & (dd <= budget)
            if also is not None:
                ok &= also
            out.append(tuple(z[ok] for z in (x0, x1, y0, y1, dd)))
        stack.append((d + 1, *(np.concatenate(z) for z in zip(*out))))
    return parent


def links(distinct: DataFrame, n: int, max_bits: int = 4, max_cell: int = MAX_CELL) -> DataFrame:
    """Spanning links (u, v) between the ``n`` distinct fingerprints of column ``fp``."""
    p, lead_bits = prefix_depth(n), max_bits // len(THIRDS)
    masks = [sum(1 << b for b in c) for k in range(1, lead_bits + 1) for c in combinations(range(p), k)]
    rot = F.array(*[F.struct(F.lit(t).alias("trie"), _rotated(F.col("fp"), k).alias("rot")) for t, k in enumerate(THIRDS)])
    own = (distinct.select(F.explode(rot).alias("r")).select("r.trie", "r.rot")
           .withColumn("cell", F.shiftrightunsigned("rot", 64 - p)))
    near = F.filter(F.transform(F.array(*[F.lit(m).cast("long") for m in [0, *masks]]), lambda m: F.col("cell").bitwiseXOR(m)),
                    lambda c: c <= F.col("cell"))
    rows = own.select("trie", "rot", F.explode(near).alias("cell"))
    heavy = written(rows.groupBy("trie", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > max_cell)
                    .select("trie", "cell", F.ceil(F.col("n") / max_cell).cast("int").alias("blocks")), "simhash-heavy")
    dealt = rows.select("trie", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "rot")
    if not heavy.isEmpty():
        block = F.pmod(F.xxhash64("rot"), F.col("blocks")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                            lambda k: F.struct(F.least(k, block).alias("i"), F.greatest(k, block).alias("j")))
        dealt = (rows.join(heavy, ["trie", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                 .withColumn("pair", F.explode(pairs)).select("trie", "cell", "pair.i", "pair.j", "rot")
                 # else the join's partitioning by (trie, cell) would keep a heavy cell in one task
                 .repartition("trie", "cell", "i", "j"))
    bounds = (*THIRDS, 64)

    def join(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        trie, cell = int(key[0]), int(key[1])
        values = np.unique(pdf["rot"].to_numpy().view(np.uint64))
        root = walk(values, p, cell, max_bits, lead_bits, bounds[trie + 1] - bounds[trie])
        k = np.uint64(THIRDS[trie])
        back = values if k == 0 else (values >> k) | (values << (np.uint64(64) - k))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"u": back[moved].view(np.int64), "v": back[root[moved]].view(np.int64)})

    return dealt.groupBy("trie", "cell", "i", "j").applyInPandas(join, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_cell: int = MAX_CELL) -> DataFrame:
    """One row per document: doc_id, text_hash, fp (signed), fingerprint (hex) and
    component_id, the smallest doc_id reachable over links."""
    rows = written(fingerprints(docs, shingle), "simhash")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    groups = connected_components(links(classes.select("fp"), classes.count(), max_bits, max_cell), "simhash-links")
    named = written(classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left"), "simhash-named")
    # a class without links names itself; one component may hold most of the others, so its rows
    # meet the component's smallest id over SALTS keys
    members = named.filter("component IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    least = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    ids = (members.join(least, ["component", "salt"]).select("fp", "component_id", "component")
           .unionByName(named.filter("component IS NULL").select("fp", F.col("first_id").alias("component_id"), F.col("fp").alias("component"))))
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "component")


def one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the document with the
    smallest doc_id stays (null ids last; of repeated rows one)."""
    groups = near_duplicates(docs, shingle, max_bits)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = written(groups.groupBy("component").agg(F.min(key).alias("k")).select("k.doc_id", "k.text_hash"), "simhash-kept")
    hashed = docs.withColumn("_sh_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    k = kept.select(F.col("doc_id").alias("_sh_id"), F.col("text_hash").alias("_sh_kept"))
    out = hashed.join(k, (F.col("_sh_hash") == F.col("_sh_kept")) & F.col("doc_id").eqNullSafe(F.col("_sh_id")))
    # only rows repeated with their id need the full-row shuffle of dropDuplicates
    if not groups.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates(["_sh_id", "_sh_kept"])
    return out.select(*docs.columns)

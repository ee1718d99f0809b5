"""Item-item cosine similarity over common raters (P23) and similar-item lookup.

For items i, j and the users U(i,j) who rated both:

    score = sum r_ui r_uj / (sqrt(sum r_ui^2) * sqrt(sum r_uj^2))   (sums over U(i,j))
    n     = |U(i,j)|;  score = 0.0 when the denominator is 0

With R the (user x item) rating matrix, Q = R*R and B the 0/1 indicator, the four sums
are the matrix products R'R, Q'B, B'Q and B'B. A per-user self-join would emit every item
pair of every user (quadratic in the items of a heavy user). Instead users are hashed
into blocks and items into blocks; each (user block, item block, item block) cell is
multiplied with numpy inside ``applyInPandas`` and already summed over the users of that
block before the shuffle: densely (BLAS) when the cell is dense, otherwise by expanding
each user's co-ratings in bounded chunks into (items x items) accumulators. A cell holds
at most users_per_block x 2 x items_per_block ratings, whatever the skew, because
ratings are one per (user, item). A rating is sent only to the cells of item blocks its
user actually rated, so the copies per rating are at most min(items of the user, item
blocks). Users with few ratings would leave such cells nearly empty, one Python call for a
handful of pairs, so their pairs (at most ``light_user`` / 2 per rating) are expanded and
partially summed by a plain self-join in the JVM; blocks are for the heavy users only. The
final sum over both is an ordinary partial aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.functions import bounded_sort
from rankfold.functions.exact import exact_sum
from rankfold.operators.popularity import with_names
from rankfold.session import measured, written

# The block-product function runs in Python workers. Pickle this module's functions by
# value so executors need only numpy and pandas, not this package on their path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package instead
    pass

PARTIAL_SCHEMA = "item1 long, item2 long, sxy double, sxx double, syy double, n long"


PAIR_CHUNK = 1 << 22      # co-rating pairs expanded at once by the sparse cell product
DENSE_SPEEDUP = 32        # BLAS multiply-adds per numpy scatter-add, roughly


def _dense_products(users, left, right, ni, nj):
    """Four block products with dense matrices over the users present in the cell."""
    nu = len(users)
    (lu, li, lr), (ru, rj, rr) = left, right
    rl = np.zeros((nu, ni))
    bl = np.zeros((nu, ni))
    rl[lu, li] = lr
    bl[lu, li] = 1.0
    rr_m = np.zeros((nu, nj))
    br = np.zeros((nu, nj))
    rr_m[ru, rj] = rr
    br[ru, rj] = 1.0
    return rl.T @ rr_m, (rl * rl).T @ br, bl.T @ (rr_m * rr_m), bl.T @ br


def _sparse_products(nu, left, right, ni, nj):
    """Same sums from co-rating pairs, expanded user by user in bounded chunks and
    scatter-added into the (ni x nj) accumulators; no pair leaves the task."""
    (lu, li, lr), (ru, rj, rr) = left, right
    order = np.argsort(ru, kind="stable")
    rj_s, rr_s = rj[order], rr[order]
    cnt = np.bincount(ru, minlength=nu)
    off = np.concatenate(([0], np.cumsum(cnt)[:-1]))
    rep = cnt[lu]                                   # partners of each left rating
    size = ni * nj
    acc = [np.zeros(size) for _ in range(4)]
    cum = np.cumsum(rep)
    start = 0
    while start < len(rep):
        done = int(cum[start - 1]) if start else 0
        stop = max(int(np.searchsorted(cum, done + PAIR_CHUNK, side="right")), start + 1)
        k = np.arange(start, stop)
        reps = rep[k]
        lidx = np.repeat(k, reps)
        first = np.cumsum(reps) - reps
        pos = np.arange(int(reps.sum())) - np.repeat(first, reps)
        ridx = off[lu[lidx]] + pos
        key = li[lidx] * nj + rj_s[ridx]
        x, y = lr[lidx], rr_s[ridx]
        acc[0] += np.bincount(key, weights=x * y, minlength=size)
        acc[1] += np.bincount(key, weights=x * x, minlength=size)
        acc[2] += np.bincount(key, weights=y * y, minlength=size)
        acc[3] += np.bincount(key, minlength=size)
        start = stop
    return tuple(a.reshape(ni, nj) for a in acc)


def _side(codes_u, pdf, mask):
    item_codes, item_ids = pd.factorize(pdf["item_id"].to_numpy()[mask])
    entries = (codes_u[mask], item_codes, pdf["rating"].to_numpy(dtype="float64")[mask])
    return np.asarray(item_ids, dtype="int64"), entries


def _cell_products(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    lo, hi = int(key[1]), int(key[2])
    codes_u, users = pd.factorize(pdf["user_id"].to_numpy())
    blk = pdf["blk"].to_numpy()
    li, left = _side(codes_u, pdf, blk == lo)
    ri, right = (li, left) if lo == hi else _side(codes_u, pdf, blk == hi)
    ni, nj = len(li), len(ri)
    if ni == 0 or nj == 0:
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in
                             [("item1", "int64"), ("item2", "int64"), ("sxy", "float64"),
                              ("sxx", "float64"), ("syy", "float64"), ("n", "int64")]})
    pairs = int(np.bincount(right[0], minlength=len(users))[left[0]].sum())
    if pairs * DENSE_SPEEDUP < len(users) * ni * nj:
        sxy, sxx, syy, n = _sparse_products(len(users), left, right, ni, nj)
    else:
        sxy, sxx, syy, n = _dense_products(users, left, right, ni, nj)
    a, b = np.meshgrid(li, ri, indexing="ij")
    keep = (n > 0) & (a != b)
    if lo == hi:
        keep &= a < b
    swap = a > b  # emit each pair with item1 < item2
    first = np.where(swap, b, a)
    second = np.where(swap, a, b)
    xx = np.where(swap, syy, sxx)
    yy = np.where(swap, sxx, syy)
    return pd.DataFrame({
        "item1": first[keep], "item2": second[keep], "sxy": sxy[keep],
        "sxx": xx[keep], "syy": yy[keep], "n": np.rint(n[keep]).astype("int64"),
    })


def cosine(sxy, sxx, syy):
    den = F.sqrt(sxx) * F.sqrt(syy)
    return F.when(den != 0, sxy / den).otherwise(F.lit(0.0))


def _light_pairs(r: DataFrame) -> DataFrame:
    """Partial sums of every item pair of every user, by a self-join on the user."""
    a = r.select("user_id", F.col("item_id").alias("item1"), F.col("rating").alias("x"))
    b = r.select("user_id", F.col("item_id").alias("item2"), F.col("rating").alias("y"))
    x, y = F.col("x"), F.col("y")
    return (a.join(b, "user_id").filter(F.col("item1") < F.col("item2")).groupBy("item1", "item2")
            .agg(F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.count(F.lit(1)).alias("n")))


def _block_pairs(r: DataFrame, users: int, items: int, users_per_block: int, items_per_block: int) -> DataFrame:
    """Partial sums from the block products of (user block, item block, item block) cells."""
    n_ub, n_ib = max(1, math.ceil(users / users_per_block)), max(1, math.ceil(items / items_per_block))
    r = (r.withColumn("ub", F.pmod(F.xxhash64("user_id"), F.lit(n_ub)).cast("int"))
         .withColumn("blk", F.pmod(F.xxhash64("item_id"), F.lit(n_ib)).cast("int")))
    # A rating is needed only by cells pairing its block with a block the same user also
    # rated: replicate to the user's own block set (at most n_ib entries per user).
    touched = r.groupBy("user_id").agg(F.collect_set("blk").alias("blks"))
    tagged = r.join(touched, "user_id").withColumn("other", F.explode("blks"))
    cells = (tagged
             .withColumn("lo", F.least("blk", "other"))
             .withColumn("hi", F.greatest("blk", "other"))
             .select("ub", "lo", "hi", "blk", "user_id", "item_id", "rating"))
    return cells.groupBy("ub", "lo", "hi").applyInPandas(_cell_products, PARTIAL_SCHEMA)


LIGHT_USER = 32


def item_similarity(ratings: DataFrame, items_per_block: int = 1024, users_per_block: int = 2048,
                    decimals: int = 6, light_user: int = LIGHT_USER) -> DataFrame:
    """(item1 < item2, score, n_pairs) for every pair with at least one common rater.

    ``ratings`` must hold one row per (user_id, item_id) (see ratings de-duplication). Users
    with at most ``light_user`` ratings are paired by a join, the others by block products."""
    r = written(ratings.select(F.col("user_id").cast("long").alias("user_id"),
                               F.col("item_id").cast("long").alias("item_id"),
                               F.col("rating").cast("double").alias("rating")), "similarity-input")
    counts = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
    sizes = counts.agg(F.count(F.when(F.col("c") > light_user, 1)).alias("heavy"), F.count(F.lit(1)).alias("u")).first()
    marked = r.join(counts, "user_id")
    parts = []
    if sizes["heavy"] < sizes["u"] or not sizes["u"]:
        parts.append(_light_pairs(marked.filter(F.col("c") <= light_user).drop("c")))
    if sizes["heavy"]:
        items = r.agg(F.approx_count_distinct("item_id")).first()[0]
        parts.append(_block_pairs(marked.filter(F.col("c") > light_user).drop("c"), sizes["heavy"], items,
                                  users_per_block, items_per_block))
    partial = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    sums = partial.groupBy("item1", "item2").agg(
        F.sum("sxy").alias("sxy"), F.sum("sxx").alias("sxx"), F.sum("syy").alias("syy"),
        F.sum("n").alias("n_pairs"))
    return sums.select("item1", "item2",
                       F.round(cosine(F.col("sxy"), F.col("sxx"), F.col("syy")), decimals).alias("score"),
                       "n_pairs")


def similarity_to(ratings: DataFrame, x: int, decimals: int = 6, exact: bool = False) -> DataFrame:
    """One row of the similarity matrix: (item_id, score, n_pairs) of every item sharing a
    rater with ``x``. Linear in the ratings: each user contributes one rating of x, so
    the join on user_id never multiplies rows beyond the user's own ratings. ``exact``: the sums,
    and so the scores, have the same bits whatever the partitioning."""
    total = exact_sum if exact else F.sum
    rx = (ratings.filter(F.col("item_id") == x)
          .select("user_id", F.col("rating").alias("rx")))
    others = ratings.filter(F.col("item_id") != x).select("user_id", "item_id", "rating")
    sums = (others.join(rx, "user_id").groupBy("item_id").agg(
        total(F.col("rx") * F.col("rating")).alias("sxy"),
        total(F.col("rx") * F.col("rx")).alias("sxx"),
        total(F.col("rating") * F.col("rating")).alias("syy"),
        F.count(F.lit(1)).alias("n_pairs")))
    return sums.select(F.col("item_id").cast("long").alias("item_id"), F.round(cosine(F.col("sxy"), F.col("sxx"), F.col("syy")), decimals)
                       .alias("score"), "n_pairs")


def similar_items(ratings: DataFrame, items: DataFrame, x: int, min_score: float, min_pairs: int,
                  n: int = 10, decimals: int = 6, exact: bool = False) -> DataFrame:
    """Items most similar to ``x`` with score > min_score and n_pairs > min_pairs,
    sorted by (score, n_pairs) descending, top n, with names."""
    order = (F.col("score").desc(), F.col("n_pairs").desc(), F.col("item_id").asc())
    top = (similarity_to(ratings, x, decimals, exact)
           .filter((F.col("score") > min_score) & (F.col("n_pairs") > min_pairs))
           .orderBy(*order).limit(n))
    return bounded_sort(with_names(top, items).select("item_id", "name", "score", "n_pairs"), n, *order)


def similar_items_from(sims: DataFrame, items: DataFrame, x: int, min_score: float, min_pairs: int,
                       n: int = 10) -> DataFrame:
    """P24 over a stored pair table (``item_similarity`` output): either side equal to x,
    the other side reported."""
    order = (F.col("score").desc(), F.col("n_pairs").desc(), F.col("item_id").asc())
    other = F.when(F.col("item1") == x, F.col("item2")).otherwise(F.col("item1"))
    top = (sims.filter(((F.col("item1") == x) | (F.col("item2") == x))
                       & (F.col("score") > min_score) & (F.col("n_pairs") > min_pairs))
           .select(other.alias("item_id"), "score", "n_pairs").orderBy(*order).limit(n))
    return bounded_sort(with_names(top, items).select("item_id", "name", "score", "n_pairs"), n, *order)


# ------------------------------------------------------------------ a stored table for lookups

PAIRS_PER_BUCKET = 4_000_000


def write_pair_store(sims: DataFrame, table: str, path: str, rows_per_bucket: int = PAIRS_PER_BUCKET) -> str:
    """Keep a pair table (``item_similarity`` output) for lookups by item: the catalog table
    ``table`` over files in ``path`` holds every pair in both directions (item_id, other_id, score,
    n_pairs), bucketed and sorted by ``item_id``, a bucket for about ``rows_per_bucket`` rows. No
    order over all pairs is made. One item has at most as many rows as there are other items."""
    spark = sims.sparkSession
    def way(a: str, b: str):
        return F.struct(F.col(a).alias("item_id"), F.col(b).alias("other_id"))

    ways = F.inline(F.array(way("item1", "item2"), way("item2", "item1")))
    both, seen = measured(sims.select(ways, "score", "n_pairs"), "pair-store", n=F.count(F.lit(1)))
    buckets = max(1, -(-seen["n"] // rows_per_bucket))
    (both.repartition(buckets, "item_id").write.mode("overwrite").bucketBy(buckets, "item_id").sortBy("item_id")
     .option("path", path).saveAsTable(table))
    return table


def pairs_of(store: DataFrame, x: int) -> DataFrame:
    """(item_id, score, n_pairs) of the items paired with ``x`` in a stored table
    (``spark.table`` of ``write_pair_store``); only x's bucket is read."""
    return store.filter(F.col("item_id") == x).select(F.col("other_id").alias("item_id"), "score", "n_pairs")


def similar_items_stored(store: DataFrame, items: DataFrame, x: int, min_score: float, min_pairs: int, n: int = 10) -> DataFrame:
    """P24 by one lookup in a stored table."""
    order = (F.col("score").desc(), F.col("n_pairs").desc(), F.col("item_id").asc())
    top = pairs_of(store, x).filter((F.col("score") > min_score) & (F.col("n_pairs") > min_pairs)).orderBy(*order).limit(n)
    return bounded_sort(with_names(top, items).select("item_id", "name", "score", "n_pairs"), n, *order)

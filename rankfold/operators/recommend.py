"""Matrix-factorization recommendation workflow.

Ratings are ``(user_id, item_id, rating, ts)`` with one row per (user, item) (see the
de-duplication in the test mapping; duplicates would multiply rows in RMSE joins).
Training uses the distributed block ALS of ``pyspark.ml``; everything else is plain
DataFrame aggregation. Only scalars reach the driver (a max id, a mean, an RMSE per grid
setting).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product
from math import isnan
from threading import Lock

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfold.functions import bounded_broadcast, epoch_seconds, hash_below, literal_rows
from rankfold.functions.exact import exact_sum
from rankfold.operators.popularity import item_counts, with_names
from rankfold.session import checkpoint_dir

TRAIN, VALIDATION, TEST = "train", "validation", "test"


# ------------------------------------------------------------------ data preparation

def rating_summary(ratings: DataFrame) -> DataFrame:
    """Number of ratings, distinct users and distinct items in one aggregate."""
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.countDistinct("user_id").alias("n_users"),
                       F.countDistinct("item_id").alias("n_items"))


def most_rated_pool(ratings: DataFrame, n: int = 50) -> DataFrame:
    """The n most rated items (ties: smaller id first)."""
    return (item_counts(ratings).orderBy(F.col("n_ratings").desc(), F.col("item_id").asc())
            .limit(n))


def elicitation_sample(pool: DataFrame, items: DataFrame, fraction: float = 0.2, seed: int = 0) -> DataFrame:
    """A seeded fraction of the pool with names. The draw is a hash of (item, seed),
    so it does not depend on row order or partitioning."""
    chosen = pool.filter(hash_below("item_id", seed, fraction)).select("item_id")
    return items.select("item_id", "name").join(chosen, "item_id").orderBy("item_id")


def with_split(ratings: DataFrame, scheme: str = "68") -> DataFrame:
    """Label each rating by ``epoch seconds % 10`` (``ts``: timestamp or epoch seconds).

    scheme "68": train < 6, validation 6-7, test >= 8;
    scheme "24": train >= 4, validation 2-3, test < 2."""
    b = epoch_seconds(ratings, "ts") % 10
    if scheme == "68":
        label = F.when(b < 6, TRAIN).when(b < 8, VALIDATION).otherwise(TEST)
    elif scheme == "24":
        label = F.when(b >= 4, TRAIN).when(b >= 2, VALIDATION).otherwise(TEST)
    else:
        raise ValueError(f"unknown split scheme {scheme!r}")
    return ratings.withColumn("split", label)


def split_counts(ratings: DataFrame, scheme: str = "68") -> DataFrame:
    return with_split(ratings, scheme).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def write_splits(labelled: DataFrame, path: str) -> str:
    """Keep ratings labelled by ``with_split``: a table partitioned by split."""
    labelled.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str, schema: StructType) -> DataFrame:
    """One split of ``write_splits``; ``schema`` is that of the labelled ratings. Only the split's
    folder is read."""
    return spark.read.schema(schema).parquet(path).filter(F.col("split") == split).drop("split")


def next_user_id(ratings: DataFrame) -> int:
    """A user id not present yet (max + 1); the scalar is the only value collected."""
    top = ratings.agg(F.max("user_id")).first()[0]
    return 0 if top is None else int(top) + 1


MAX_ANSWERS = 10_000


def supplied_ratings(spark: SparkSession, user: int, answers: Iterable[tuple[int, float]], seen_only: bool = False) -> DataFrame:
    """(user_id, item_id, rating) of one user from a collection of (item, rating) answers on the
    driver, at most ``MAX_ANSWERS`` of them. A rating is 0 ("not seen") to 5; an item may be
    answered once. ``seen_only`` leaves the zeros out. No answers give an empty table."""
    rows = [(int(user), int(item), float(rating)) for item, rating in answers]
    if len(rows) > MAX_ANSWERS:
        raise ValueError(f"{len(rows)} answers: read them as a table instead")
    if wrong := [r for r in rows if not 0 <= r[2] <= 5]:  # also not a number
        raise ValueError(f"ratings outside 0 to 5: {wrong[:5]}")
    if len({r[1] for r in rows}) < len(rows):
        raise ValueError("an item is answered twice")
    return spark.createDataFrame([r for r in rows if r[2] or not seen_only], "user_id long, item_id int, rating double")


def add_user_ratings(train: DataFrame, supplied: DataFrame) -> DataFrame:
    """Append a user's supplied ratings; 0 means "not seen" and is dropped, 1-5 kept."""
    kept = supplied.filter(F.col("rating").between(1, 5))
    cols = ["user_id", "item_id", "rating"]
    return train.select(*cols).unionByName(kept.select(*cols))


def user_history(ratings: DataFrame, items: DataFrame, user: int) -> DataFrame:
    """One user's ratings with item names."""
    mine = ratings.filter(F.col("user_id") == user).select("item_id", "rating")
    return mine.join(items.select("item_id", "name"), "item_id").select("item_id", "name", "rating")


# ------------------------------------------------------------------ models

def _als_input(df: DataFrame) -> DataFrame:
    return df.select(F.col("user_id").cast("int").alias("user_id"),
                     F.col("item_id").cast("int").alias("item_id"),
                     F.col("rating").cast("float").alias("rating"))


RATINGS_PER_BLOCK = 25_000
MIN_PER_BLOCK = 2_000_000


def als_blocks(n: int, parallelism: int) -> int:
    """User/item block count for ``n`` ratings: about RATINGS_PER_BLOCK ratings a block up to
    one block per core (fewer, larger blocks cost less per iteration when small), and never
    more than MIN_PER_BLOCK ratings a block, however many there are."""
    return max(1, min(parallelism, -(-n // RATINGS_PER_BLOCK)), -(-n // MIN_PER_BLOCK))


def fit_als(train: DataFrame, rank: int = 8, max_iter: int = 20, reg: float = 0.01, seed: int = 42,
            blocks: int | None = None) -> ALSModel:
    """Block ALS. Iteration state is checkpointed to the shared checkpoint folder every
    10 iterations (cuts lineage; without it long runs overflow the stack). The input is
    persisted, so its size and the fit share one computation. Ids must fit 32 bits, as
    ``pyspark.ml`` requires; the cast raises beyond that."""
    data = _als_input(train).persist()
    try:
        nb = blocks or als_blocks(data.count(), train.sparkSession.sparkContext.defaultParallelism)
        return _fit(data, rank, max_iter, reg, seed, nb)
    finally:
        data.unpersist()


def _fit(data: DataFrame, rank: int, max_iter: int, reg: float, seed: int, blocks: int) -> ALSModel:
    """Fit on ``_als_input`` rows that the caller has persisted."""
    checkpoint_dir(data.sparkSession)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user_id",
              itemCol="item_id", ratingCol="rating", coldStartStrategy="drop",
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=10)
    return als.fit(data)


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for (user, item) pairs; unknown users or items give no row."""
    model.setColdStartStrategy("drop")
    return (model.transform(pairs.select(F.col("user_id").cast("int").alias("user_id"),
                                         F.col("item_id").cast("int").alias("item_id")))
            .select("user_id", "item_id", F.col("prediction").cast("double").alias("prediction")))


def rmse_frame(scored: DataFrame, exact: bool = False) -> DataFrame:
    """One row ``rmse``: sqrt(sum of squared errors over rows with a prediction / number of
    all rows); null without rows. Rows whose ``prediction`` is NaN or null (cold start) count
    in the divisor only. ``exact``: the same bits whatever the partitioning."""
    ok = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    err = F.when(ok, F.pow(F.col("prediction") - F.col("rating"), 2))
    n = F.count(F.lit(1))
    return scored.agg(F.when(n > 0, F.sqrt(F.coalesce((exact_sum if exact else F.sum)(err), F.lit(0.0)) / n)).alias("rmse"))


def rmse_scored(scored: DataFrame) -> float:
    """``rmse_frame`` as a number (NaN without rows)."""
    value = rmse_frame(scored).first()["rmse"]
    return float("nan") if value is None else float(value)


def item_mean_scored(train: DataFrame, rows: DataFrame, shrink: float = 0.0) -> DataFrame:
    """``rows`` with ``prediction``, the item's mean in ``train`` with ``shrink`` imaginary
    ratings at the mean of all of ``train``; null for items that train does not hold. A
    deterministic stand-in for a model: everything downstream treats it like ALS."""
    mean = train.agg(F.avg("rating")).first()[0] or 0.0
    per_item = train.groupBy("item_id").agg(F.sum("rating").alias("_s"), F.count(F.lit(1)).alias("_n"))
    guess = (F.col("_s") + F.lit(float(shrink) * mean)) / (F.col("_n") + F.lit(float(shrink)))
    return rows.join(per_item.select("item_id", guess.alias("prediction")), "item_id", "left")


def grid_choice(settings, score) -> tuple[list[tuple], int]:
    """([(setting, score)], index of the smallest score; the first setting wins ties, and any
    score wins over NaN)."""
    rows = [(s, score(s)) for s in settings]
    return rows, min(range(len(rows)), key=lambda i: (isnan(rows[i][1]), rows[i][1] if not isnan(rows[i][1]) else 0.0, i))


def rmse_value(model: ALSModel, data: DataFrame) -> float:
    """RMSE of ``model`` on ``data`` with the whole split as divisor (one pass:
    predictions are NaN for unknown ids)."""
    model.setColdStartStrategy("nan")
    try:
        return rmse_scored(model.transform(_als_input(data)))
    finally:
        model.setColdStartStrategy("drop")


@dataclass
class GridResult:
    rows: list[tuple]            # (rank, reg, max_iter, validation_rmse)
    best: tuple                  # best row
    model: ALSModel


GRID_SLOTS = 4


def als_grid_search(train: DataFrame, validation: DataFrame, ranks=(8, 12), regs=(0.1, 10.0),
                    iters=(10, 20), seed: int = 42, slots: int = GRID_SLOTS) -> GridResult:
    """Fit every (rank, reg, iterations) setting; keep the smallest validation RMSE
    (strict <, so the first setting wins ties).

    The inputs are persisted once. Up to ``slots`` fits run at a time, each submitted by a thread
    of its own: an iteration is a chain of small stages, so one fit alone leaves cores idle at
    every barrier. A slot holds the factors of one fit. The order in which fits end has no
    effect, and only the best model so far is kept."""
    settings = list(product(ranks, regs, iters))
    train, validation = _als_input(train).persist(), _als_input(validation).persist()
    try:
        blocks = als_blocks(train.count(), train.sparkSession.sparkContext.defaultParallelism)
        validation.count()  # cached by one job, not by the first fits together

        scores: dict[int, float] = {}
        kept: dict[int, ALSModel] = {}
        lock = Lock()

        def run(i: int) -> None:
            rank, reg, it = settings[i]
            model = _fit(train, rank, it, reg, seed, blocks)
            v = rmse_value(model, validation)
            with lock:
                scores[i], kept[i] = v, model
                done = sorted(scores)
                best = done[grid_choice(done, scores.get)[1]]
                for j in [j for j in kept if j != best]:
                    del kept[j]

        with ThreadPoolExecutor(max(1, min(slots, len(settings)))) as pool:
            list(pool.map(inheritable_thread_target(train.sparkSession)(run), range(len(settings))))
    finally:
        validation.unpersist()
        train.unpersist()   # fitted models keep their own factor tables
    rows = [(int(rank), float(reg), int(it), scores[i]) for i, (rank, reg, it) in enumerate(settings)]
    (best, model), = kept.items()
    return GridResult(rows, rows[best], model)


@dataclass
class Report:
    """Everything the recommendation job prints, from one grid search."""

    grid: GridResult
    test_rmse: float
    baseline_rmse: float | None
    improvement_pct: float | None
    recommendations: DataFrame


def recommend_report(train: DataFrame, validation: DataFrame, test: DataFrame, items: DataFrame, user: int, n: int = 50,
                     **grid) -> Report:
    """P40-P44 with the best model of one search: test RMSE, mean baseline, improvement and the
    top-n unseen items of ``user`` (whose ratings are part of ``train``)."""
    found = als_grid_search(train, validation, **grid)
    rmse = rmse_value(found.model, test)
    base = mean_baseline_rmse(train, validation, test).first()[0]
    improvement = improvement_pct(base, rmse) if base else None
    return Report(found, rmse, base, improvement, recommend_unseen(found.model, items, train, user, n))


def report_frame(spark, report: Report) -> DataFrame:
    """The figures of a report as one row."""
    rank, reg, max_iter, validation_rmse = report.grid.best
    cols = [("rank", "int"), ("reg", "double"), ("max_iter", "int"), ("validation_rmse", "double"), ("test_rmse", "double"),
            ("baseline_rmse", "double"), ("improvement_pct", "double")]
    return literal_rows(spark, cols, [(rank, reg, max_iter, validation_rmse, report.test_rmse, report.baseline_rmse, report.improvement_pct)])


def grid_frame(spark, result: GridResult) -> DataFrame:
    data = [(r, g, i, v, (r, g, i, v) == result.best) for r, g, i, v in result.rows]
    cols = [("rank", "int"), ("reg", "double"), ("max_iter", "int"), ("validation_rmse", "double"),
            ("best", "boolean")]
    return literal_rows(spark, cols, data)


def mean_baseline_rmse(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE of predicting the mean of train + validation for every test rating."""
    cols = ["rating"]
    mean = train.select(*cols).unionByName(validation.select(*cols)).agg(F.avg("rating")).first()[0]
    return test.agg(F.sqrt(F.avg(F.pow(F.lit(mean) - F.col("rating"), 2))).alias("baseline_rmse"))


def mean_baseline(labelled: DataFrame) -> DataFrame:
    """P42 in one pass over ratings labelled by ``with_split``: with m the mean of the other
    splits, the mean of (m - r)^2 over test is (n m^2 - 2 m sum r + sum r^2) / n."""
    test = F.col("split") == TEST
    r = F.col("rating")
    sums = labelled.agg(F.avg(F.when(~test, r)).alias("m"), F.count(F.when(test, r)).alias("n"),
                        F.sum(F.when(test, r)).alias("s"), F.sum(F.when(test, r * r)).alias("q"))
    mse = (F.col("n") * F.col("m") * F.col("m") - 2 * F.col("m") * F.col("s") + F.col("q")) / F.col("n")
    return sums.select(F.when(F.col("n") > 0, F.sqrt(F.greatest(mse, F.lit(0.0)))).alias("baseline_rmse"))


def improvement_pct(baseline_rmse: float, model_rmse: float) -> float | None:
    """(baseline - model) / baseline * 100, two decimals; None if the baseline is 0."""
    return round((baseline_rmse - model_rmse) / baseline_rmse * 100.0, 2) if baseline_rmse else None


def fold_in(factors: DataFrame, ratings: DataFrame, reg: float) -> DataFrame:
    """P36/P38 without a refit: (user_id, features) of the users of ``ratings``, against fixed item
    ``factors`` (id, features) of a model.

    A user's factors x minimise sum (r - x.v)^2 + reg * n * |x|^2 over their n ratings of items with
    factors v, as one half-step of ALS does: (sum v v' + reg * n) x = sum r v. The sums are
    ordinary partial aggregates, so a user with any number of ratings is summed before
    the shuffle; only one small system a user is solved, in batches. Users none of whose items has
    factors give no row, as do users whose system is singular (``reg`` 0, too few ratings)."""
    first = factors.select(F.size("features")).first()
    rank = int(first[0]) if first else 0
    rated = (ratings.select("user_id", F.col("item_id").alias("_item"), F.col("rating").cast("double").alias("r"))
             .join(factors.select(F.col("id").alias("_item"), F.col("features").cast("array<double>").alias("v")), "_item"))
    v = [F.get("v", F.lit(i)) for i in range(rank)]
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    sums = rated.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i, j in pairs], *[F.sum(v[i] * F.col("r")).alias(f"b{i}") for i in range(rank)])
    packed = sums.select("user_id", F.array("n", *[f"a{i}_{j}" for i, j in pairs], *[f"b{i}" for i in range(rank)]).alias("sums"))
    upper = tuple(np.triu_indices(rank))

    def solve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for s in batch:
                a = np.zeros((rank, rank))
                a[upper] = s[1:1 + len(upper[0])]
                a = a + np.triu(a, 1).T + reg * s[0] * np.eye(rank)
                try:
                    out.append(np.linalg.solve(a, np.asarray(s[1 + len(upper[0]):])).tolist())
                except np.linalg.LinAlgError:
                    out.append(None)
            yield pd.Series(out)

    features = F.pandas_udf(solve, "array<double>")("sums")
    return packed.select("user_id", features.alias("features")).filter(F.col("features").isNotNull())


def score_items(users: DataFrame, factors: DataFrame) -> DataFrame:
    """(user_id, item_id, prediction) of a few users for all items: the inner product of their
    features. ``users`` must be few: they are broadcast to the items if their number is proven by the plan."""
    items = factors.select(F.col("id").alias("item_id"), F.col("features").cast("array<double>").alias("v"))
    product = F.aggregate(F.zip_with("features", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return items.join(bounded_broadcast(users), F.lit(True)).select("user_id", "item_id", product.alias("prediction"))


def recommend_new_user(factors: DataFrame, items: DataFrame, supplied: DataFrame, user: int, reg: float, n: int = 50) -> DataFrame:
    """P44 for a user the model does not know: their ``supplied`` ratings (user_id, item_id, rating;
    1 to 5, others are dropped) are folded in and the n best items they have not rated returned."""
    mine = supplied.filter((F.col("user_id") == user) & F.col("rating").between(1, 5))
    scored = score_items(fold_in(factors, mine, reg).limit(1), factors)  # one user, one row
    return top_scored(items, scored.join(unseen_items(items, mine, user).select("item_id"), "item_id", "left_semi"), n)


def recommend_for_user(model: ALSModel, items: DataFrame, user: int, n: int = 10) -> DataFrame:
    """Top-n items for a user, already-rated items included."""
    spark = items.sparkSession
    who = spark.range(1).select(F.lit(int(user)).cast("int").alias("user_id"))
    recs = (model.recommendForUserSubset(who, n)
            .select(F.explode("recommendations").alias("r"))
            .select(F.col("r.item_id").cast("long").alias("item_id"),
                    F.col("r.rating").cast("double").alias("prediction")))
    return top_scored(items, recs, n)


def unseen_items(items: DataFrame, ratings: DataFrame, user: int) -> DataFrame:
    """(item_id, user_id) of the catalogue items the user has not rated."""
    rated = ratings.filter(F.col("user_id") == user).select("item_id")
    return items.select("item_id").distinct().join(rated, "item_id", "left_anti").withColumn("user_id", F.lit(int(user)))


def top_scored(items: DataFrame, scored: DataFrame, n: int) -> DataFrame:
    """The n best predictions, numbered 1..n, with names (null if the catalogue has none)."""
    top = (scored.select(F.col("item_id").cast("long").alias("item_id"), "prediction")
           .orderBy(F.col("prediction").desc(), F.col("item_id").asc()).limit(n))
    # row_number over at most n rows (a top-n result), never over the raw data
    w = Window.orderBy(F.col("prediction").desc(), F.col("item_id").asc())
    ranked = top.withColumn("rank", F.row_number().over(w))
    return with_names(ranked, items).select("rank", "item_id", "name", "prediction").orderBy("rank")


def recommend_unseen(model: ALSModel, items: DataFrame, ratings: DataFrame, user: int,
                     n: int = 50) -> DataFrame:
    """Top-n catalogue items the user has not rated, numbered 1..n, with names."""
    return top_scored(items, als_predict(model, unseen_items(items, ratings, user)), n)

"""Exact sums and SQL functions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rankfold.functions import exact
from rankfold.functions import sql as rf


def total(df):
    return df.agg(exact.exact_sum(F.col("x")).alias("s")).first()["s"]


@pytest.mark.parametrize("seed", [1, 2])
def test_sum_is_the_same_bits_in_any_order(spark, seed):
    rng = random.Random(seed)
    xs = [rng.choice((1, -1)) * rng.random() * 10 ** rng.randint(-9, 12) for _ in range(3000)] + [1e15, -1e15, 0.1, 1e-17, 2.0 ** 62]
    want = float(sum(map(Fraction, xs)))
    got, plain = set(), set()
    for parts in (1, 7, 40):
        rng.shuffle(xs)
        df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(parts)
        got.add(total(df))
        plain.add(math.fsum(xs))
    assert len(got) == 1
    (s,) = got
    assert math.isclose(s, want, rel_tol=2 ** -50) and {want} == plain


def test_sum_edges(spark):
    def of(*xs):
        return total(spark.createDataFrame([(x,) for x in xs], "x double"))

    assert of() is None and of(None) is None and of(None, 0.5) == 0.5 and of(-0.25, -0.5) == -0.75 and of(1e-30) == pytest.approx(1e-30, rel=1e-5)
    assert math.isnan(of(float("nan"), 1.0)) and math.isnan(of(float("inf"))) and math.isnan(of(2.0 ** 63))
    assert of(2.0 ** 62, 2.0 ** 62, -2.0 ** 62) == 2.0 ** 62 and of(-1.0, 1.0) == 0.0


def test_scores_and_errors_do_not_follow_the_partitioning(spark):
    from rankfold.operators import recommend, similarity

    rng = random.Random(4)
    rows = [(u, i, rng.random() * 5) for u in range(150) for i in range(12) if rng.random() < 0.7]
    scores, errors = set(), set()
    for parts in (1, 5, 23):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "user_id long, item_id long, rating double").repartition(parts)
        scores.add(tuple(sorted(map(tuple, similarity.similarity_to(df, 3, decimals=17, exact=True).collect()))))
        errors.add(recommend.rmse_frame(df.withColumn("prediction", F.lit(2.5)), exact=True).first()[0])
    assert len(scores) == len(errors) == 1
    plain = {r[0]: r[1] for r in similarity.similarity_to(df, 3, decimals=9).collect()}
    assert all(math.isclose(s, plain[i], abs_tol=1e-8) for i, s, _ in scores.pop())


@pytest.fixture(scope="module")
def sql(spark):
    names = rf.register(spark)
    yield spark.sql
    for n in names:
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {n}")


def test_scalar_functions(sql):
    row = sql("SELECT rf_cosine(24, 25, 25), rf_cosine(0, 0, 4), rf_fahrenheit(-148), rf_int_mean(7, 2), rf_int_mean(-7, 2), "
              "rf_bucket(881250949), rf_split(5), rf_split(7), rf_split(9)").first()
    assert tuple(row) == (0.96, 0.0, 5.36, 3, -3, 9, "train", "validation", "test")


def test_table_functions(sql):
    def of(call):
        return [tuple(r) for r in sql(f"SELECT * FROM {call}").collect()]

    assert of("rf_tokens('-a b--')") == [("",), ("a",), ("b",)] and of("rf_tokens('---')") == [] and of("rf_tokens('')") == [("",)]
    assert of("rf_tags('a|b', '|')") == [("a",), ("b",)]
    assert of("rf_rating('1::2::3.5::4', '::')") == [(1, 2, 3.5, 4)] and of("rf_rating('1,2,x,4', ',')") == [] and of("rf_rating('1,2,3', ',')") == []
    assert of("rf_neighbours('5 6 7 ')") == [(5, 6), (5, 7)] and of("rf_neighbours('x 1')") == [] and of("rf_neighbours('')") == []
    assert of("""rf_node_name('1 "A B"')""") == [(1, "A B")] and of("rf_node_name('1 A')") == []


def test_functions_plan_without_python(spark, sql):
    spark.createDataFrame([("a b",), ("b",)], "line string").createOrReplaceTempView("rf_lines")
    df = sql("SELECT token, count(*) AS n FROM rf_lines, LATERAL rf_tokens(line) GROUP BY token")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", 2)] and "Python" not in plan and "Join" not in plan

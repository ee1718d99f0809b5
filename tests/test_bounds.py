"""Proven row bounds, one-file reports and answers given as a collection."""

import glob

import pytest
from pyspark.sql import functions as F

from rankfold.functions import bounded_broadcast, bounded_sort, proven_rows
from rankfold.operators import popularity, recommend
from rankfold.sources import read_tag_report, write_tag_report_file


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_rows_are_proven_by_the_plan(spark):
    df = spark.range(1000).repartition(3)
    grouped = df.groupBy((F.col("id") % 7).alias("k")).count()
    assert proven_rows(grouped.orderBy("k").limit(5)) == 5
    assert proven_rows(grouped.agg(F.sum("count"))) == 1
    assert proven_rows(spark.read.parquet("/root/testdata/sf0.001/part.parquet")) is None


def test_broadcast_hint_needs_a_proven_size(spark):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select("p_partkey")
    assert hinted(bounded_broadcast(parts.limit(10)))
    assert not hinted(bounded_broadcast(parts))  # no bound, whatever its size
    assert not hinted(bounded_broadcast(parts.limit(100_000_000)))  # a bound beyond the threshold
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not hinted(bounded_broadcast(parts.limit(10)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_final_order_has_no_range_exchange(spark):
    df = bounded_sort(spark.range(1000).repartition(7).limit(20), 20, F.col("id").desc())
    assert "rangepartitioning" not in plan(df)
    got = [r["id"] for r in df.collect()]
    assert got == sorted(got, reverse=True) and len(got) == 20


def test_names_by_one_join(spark):
    top = spark.createDataFrame([(1, 9), (2, 8), (3, 7), (None, 6)], "item_id int, n_ratings long").limit(4)
    items = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (5, "e"), (None, "n")], "item_id long, name string")
    out = popularity.with_names(top, items)
    assert plan(out).count("Join") - plan(out).count("JoinedRow") >= 1 and dict(out.dtypes) == {"item_id": "int", "n_ratings": "bigint", "name": "string"}
    assert sorted(map(tuple, out.collect()), key=lambda r: -r[1]) == [(1, 9, "a"), (2, 8, None), (3, 7, None), (None, 6, None)]
    assert popularity.with_names(top, items.limit(0)).count() == 4 and popularity.with_names(top.limit(0), items).count() == 0


def test_one_ranked_file(spark, tmp_path):
    rows = [(i, f'tag "{i}", x', 1000 - i, 3, (1000 - i) // 3) for i in range(1, 501)]
    report = spark.createDataFrame(rows, "rank long, tag string, n_ratings long, n_items long, ratio long").repartition(9)
    path = write_tag_report_file(report, str(tmp_path / "report"))
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 1
    with open(files[0]) as f:
        assert [int(line.split(",")[0]) for line in f] == list(range(1, 501))
    assert sorted(map(tuple, read_tag_report(spark, path).collect())) == rows
    with pytest.raises(ValueError, match="500 rows"):
        write_tag_report_file(report, str(tmp_path / "other"), max_rows=499)
    assert not (tmp_path / "other").exists()
    assert read_tag_report(spark, write_tag_report_file(report.limit(0), str(tmp_path / "none"))).count() == 0


def test_answers_as_a_collection(spark):
    got = recommend.supplied_ratings(spark, 9, [(1, 0), (2, 5), (3, 2.5)])
    assert sorted(map(tuple, got.collect())) == [(9, 1, 0.0), (9, 2, 5.0), (9, 3, 2.5)]
    assert recommend.supplied_ratings(spark, 9, [(1, 0), (2, 5)], seen_only=True).count() == 1
    train = spark.createDataFrame([(1, 1, 4.0)], "user_id long, item_id int, rating double")
    assert sorted(map(tuple, recommend.add_user_ratings(train, got).collect())) == [(1, 1, 4.0), (9, 2, 5.0), (9, 3, 2.5)]
    assert recommend.supplied_ratings(spark, 9, []).count() == 0
    for answers in ([(1, 6)], [(1, -1)], [(1, float("nan"))], [(1, 2), (1, 3)], [(i, 1) for i in range(recommend.MAX_ANSWERS + 1)]):
        with pytest.raises(ValueError):
            recommend.supplied_ratings(spark, 9, answers)

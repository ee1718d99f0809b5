"""Tables kept for lookups: only what a lookup needs is read."""

import random

from pyspark.sql import functions as F

from rankfold.operators import dictionary, similarity


def test_pair_store_reads_one_bucket(spark, tmp_path):
    rng = random.Random(1)
    data = [(a, b, rng.random(), rng.randint(1, 99)) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.5]
    sims = spark.createDataFrame(data, "item1 long, item2 long, score double, n_pairs long")
    name = similarity.write_pair_store(sims, "rankfold_test_pairs", str(tmp_path / "pairs"), rows_per_bucket=200)
    try:
        store = spark.table(name)
        assert store.count() == 2 * len(data)
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", False)  # else the plan does not name the buckets
        found = similarity.pairs_of(store, 7)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"SelectedBucketsCount: 1 out of {-(-2 * len(data) // 200)}" in plan and "Sort" not in plan
        want = {(b if a == 7 else a, s, n) for a, b, s, n in data if 7 in (a, b)}
        assert {tuple(r) for r in found.collect()} == want
        items = spark.range(60).select(F.col("id").alias("item_id"), F.concat(F.lit("n"), "id").alias("name"))
        top = similarity.similar_items_stored(store, items, 7, 0.2, 10, 5).collect()
        best = sorted(((i, s, n) for i, s, n in want if s > 0.2 and n > 10), key=lambda r: (-r[1], -r[2], r[0]))[:5]
        assert [(r.item_id, r.name, r.score, r.n_pairs) for r in top] == [(i, f"n{i}", s, n) for i, s, n in best]
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_empty_pair_store(spark, tmp_path):
    sims = spark.createDataFrame([], "item1 long, item2 long, score double, n_pairs long")
    name = similarity.write_pair_store(sims, "rankfold_test_no_pairs", str(tmp_path / "pairs"))
    assert similarity.pairs_of(spark.table(name), 7).count() == 0
    spark.sql(f"DROP TABLE {name}")


def rows_scanned(df):
    """Rows that the plan's file scan handed on, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan], 0
    while todo:
        p = todo.pop()
        if "FileScan" in p.nodeName() or p.nodeName().startswith("Scan"):
            out += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_lookup_reads_a_few_pages(spark, tmp_path):
    names = spark.range(300_000).select((F.col("id") * 2).alias("item_id"), F.concat(F.lit("name "), "id").alias("name"))
    path = dictionary.write_dictionary(names, str(tmp_path / "names"), files=6, row_group_bytes=1 << 18, page_rows=500)
    store = spark.read.parquet(path)
    found = dictionary.lookup(store, [10, 400_000, 400_002, 599_998])
    assert sorted(tuple(r) for r in found.collect()) == [(10, "name 5"), (400_000, "name 200000"), (400_002, "name 200001"), (599_998, "name 299999")]
    assert found.select(F.input_file_name()).distinct().count() <= 3
    assert rows_scanned(found) <= 3 * 2 * 500  # pages, of 300,000 rows
    # many keys too, spread over everything: still their pages only
    spread = dictionary.lookup(store, [k * 40_000 for k in range(15)])
    assert len(spread.collect()) == 15 and rows_scanned(spread) <= 15 * 2 * 500
    # keys between those that are there: the bloom filter leaves no row group
    assert rows_scanned(dictionary.lookup(store, [40_001, 300_001])) == 0


def test_names_by_lookup(spark, tmp_path):
    items = spark.createDataFrame([(1, "b"), (1, "a"), (3, "c"), (None, "n"), (4, None)], "item_id long, name string")
    store = spark.read.parquet(dictionary.write_dictionary(items, str(tmp_path / "names")))
    top = spark.createDataFrame([(3, 9), (1, 8), (2, 7), (4, 6)], "item_id long, n_ratings long").orderBy(F.desc("n_ratings"))
    got = dictionary.named(top, store, 4, F.desc("n_ratings")).collect()
    assert [tuple(r) for r in got] == [(3, 9, "c"), (1, 8, "a"), (2, 7, None), (4, 6, None)]
    none = dictionary.named(top.filter("false"), store, 4, F.desc("n_ratings"))
    assert none.columns == ["item_id", "n_ratings", "name"] and none.count() == 0
    assert dictionary.lookup(store, []).count() == 0

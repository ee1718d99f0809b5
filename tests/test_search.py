"""Breadth-first search: two-sided search against brute force, jobs a level, rows read."""

import glob
import random
from collections import Counter

import pytest

from rankfold.operators import graph
from rankfold.sources import readers


def brute(edges, start, target, max_levels=None):
    """(degree, hits) level by level, as the one-sided search has them."""
    dist, frontier, level = {start}, {start}, 0
    while frontier and (max_levels is None or level < max_levels):
        level += 1
        hits = sum(a in frontier and b == target for a, b in edges)
        if hits:
            return [(level, hits)]
        frontier = {b for a, b in edges if a in frontier} - dist
        dist |= frontier
    return []


def random_edges(seed, nodes, n):
    rng = random.Random(seed)
    edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(n)]
    return edges + edges[: n // 5]  # repeated entries are separate entries


def frame(spark, edges):
    return spark.createDataFrame(edges, "node long, neighbour long")


@pytest.mark.parametrize("seed,nodes,n", [(1, 40, 70), (2, 60, 110)])
def test_two_sided_search_matches_brute_force(spark, seed, nodes, n):
    edges = random_edges(seed, nodes, n)
    df = frame(spark, edges).cache()
    start, found = max(range(nodes), key=lambda s: sum(bool(brute(edges, s, t)) for t in range(nodes))), Counter()
    for target in random.Random(seed).sample(range(nodes), 14) + [start, nodes + 1]:
        want = brute(edges, start, target)
        assert [tuple(r) for r in graph.degrees_of_separation(df, start, target).collect()] == want, target
        found[want[0][0] if want else 0] += 1
    assert max(found) >= 4  # ways long enough to meet in the middle


def test_large_frontiers_and_hot_keys_take_the_same_way(spark, monkeypatch):
    edges = random_edges(3, 50, 70) + [(0, i) for i in range(30)]
    df = frame(spark, edges).cache()
    targets = [7, 21, 49]
    want = [brute(edges, 5, t) for t in targets]
    monkeypatch.setattr(graph, "SMALL_FRONTIER", 0)
    for per_bucket in (8, 4_000_000):
        got = [[tuple(r) for r in graph.degrees_of_separation(df, 5, t, rows_per_bucket=per_bucket).collect()] for t in targets]
        assert got == want


def test_level_limit_counts_both_sides(spark):
    chain = frame(spark, [(i, i + 1) for i in range(9)])
    assert [graph.degrees_of_separation(chain, 0, 9, m).count() for m in (8, 9)] == [0, 1]


def test_null_neighbours_end(spark):
    df = frame(spark, [(0, 1), (1, None), (None, 2), (1, 2)])
    assert {tuple(r) for r in graph.bfs_distances(df, 0).collect()} == {(0, 0), (1, 1), (2, 2)}
    assert [tuple(r) for r in graph.degrees_of_separation(df, 0, 2).collect()] == [(2, 1)]


def executions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


def test_a_level_is_one_job(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_FRONTIER", 0)  # no lookups of a few keys beside it

    def used(length):
        df = frame(spark, [(i, i + 1) for i in range(length)]).cache()
        df.count()
        before = executions(spark)
        graph.bfs_distances(df, 0)
        return executions(spark) - before

    assert used(9) - used(5) == 4


def test_small_frontiers_read_their_buckets_only(spark):
    df = spark.range(20_000).selectExpr("id AS src", "(id * 7) % 20000 AS dst")
    table = graph._Bucketed(df, 20_000, "src", "dst", "pruned", 1000)
    try:
        assert table.buckets == 20 and not table.has_hot
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", False)  # else the plan does not name the buckets
        plan = table.rows_of([5])._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 20" in plan
        assert [tuple(r) for r in table.rows_of([5]).collect()] == [(5, 35)]
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        table.drop()


def test_two_sides_visit_fewer_nodes_than_one(spark):
    """A tree of 4 children a node: the one-sided search writes all nodes above the target's
    level, the two-sided one a few."""
    children = [(i, 4 * i + k) for i in range(1366) for k in range(1, 5)]
    both = frame(spark, children + [(b, a) for a, b in children]).cache()

    def written():
        folder = spark.sparkContext.getCheckpointDir().replace("file:", "")
        return {p: spark.read.parquet(p).count() for p in glob.glob(f"{folder}/scratch/bfs-level*") + glob.glob(f"{folder}/scratch/bfs-back*")}

    before = set(written())
    assert [tuple(r) for r in graph.degrees_of_separation(both, 0, 5000).collect()] == [(6, 1)]
    two = {p: n for p, n in written().items() if p not in before}
    graph.bfs_distances(both, 0, 6)
    one = {p: n for p, n in written().items() if p not in before and p not in two}
    assert sum(two.values()) < sum(one.values()) / 20


def test_small_buckets_stay_few_as_the_graph_grows(spark):
    df = spark.range(20_000).selectExpr("id AS node", "id % 3 AS grp")
    table = graph._Bucketed(df, 20_000, "grp", "node", "few", 2)
    try:
        assert table.buckets <= graph.MANY_BUCKETS and table.has_hot
        got = table.semi(spark.createDataFrame([(1,)], "grp long")).select("node").collect()
        assert sorted(r[0] for r in got) == list(range(1, 20_000, 3))
    finally:
        table.drop()


def test_repeated_keys_get_their_salts_once(spark, monkeypatch):
    df = spark.range(900).selectExpr("id AS node", "id % 3 AS grp")
    table = graph._Bucketed(df, 900, "grp", "node", "repeats", 100)
    salted = []
    plain = graph._Bucketed._with_salts
    monkeypatch.setattr(graph._Bucketed, "_with_salts", lambda self, keys: salted.append(keys) or plain(self, keys))
    try:
        assert table.has_hot
        assert table.semi(df.filter("grp < 2").select("grp")).count() == 600
        assert [k.count() for k in salted] == [2]
    finally:
        table.drop()


def test_a_line_is_parsed_once(spark, tmp_path):
    file = tmp_path / "adjacency"
    file.write_text("1 2\t3\n 4\f5 \v 6  \n\t\n7\nx 8\n")
    entries = readers.adjacency_entries(readers.read_adjacency(spark, str(file)))
    assert sorted(tuple(r) for r in entries.collect()) == [(1, 2), (1, 3), (4, 5), (4, 6)]
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert sum("split(" in x and "FileScan" not in x for x in plan.splitlines()) == 1

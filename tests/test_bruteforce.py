"""Operators whose fast plan differs from the naive one, checked against brute force on
small random fixtures."""

import itertools
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from rankfold.functions import java_split
from rankfold.operators import graph, similarity


def _java_split(s: str, pattern: str) -> list[str]:
    if s == "":
        return [""]
    parts = re.split(pattern, s, flags=re.ASCII)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_random(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", " ", "-", "é", "_", "1", "  "]
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    for pattern in (r"\W+", " "):
        got = {r["i"]: r["t"] for r in df.select("i", java_split("line", pattern).alias("t")).collect()}
        for i, s in enumerate(lines):
            assert got[i] == _java_split(s, pattern), (s, pattern)


def _brute_cosine(rows):
    by_user = defaultdict(dict)
    for u, i, r in rows:
        by_user[u][i] = r
    acc = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for items in by_user.values():
        for a, b in itertools.combinations(sorted(items), 2):
            x, y = items[a], items[b]
            s = acc[(a, b)]
            s[0] += x * y
            s[1] += x * x
            s[2] += y * y
            s[3] += 1
    out = {}
    for k, (xy, xx, yy, n) in acc.items():
        den = math.sqrt(xx) * math.sqrt(yy)
        out[k] = (round(xy / den, 6) if den else 0.0, n)
    return out


def test_block_similarity_matches_pairs(spark):
    rng = random.Random(11)
    rows = {(u, i): float(rng.randint(0, 5)) for u in range(40) for i in range(25) if rng.random() < 0.3}
    # one heavy user who rated everything
    rows.update({(99, i): float(rng.randint(1, 5)) for i in range(25)})
    data = [(u, i, r) for (u, i), r in rows.items()]
    df = spark.createDataFrame(data, "user_id long, item_id long, rating double")
    got = {(r["item1"], r["item2"]): (r["score"], r["n_pairs"])
           for r in similarity.item_similarity(df, items_per_block=4, users_per_block=7).collect()}
    want = _brute_cosine(data)
    assert got.keys() == want.keys()
    for k, (score, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - score) <= 1e-6, k


def test_similarity_row_matches_full_table(spark):
    rng = random.Random(3)
    data = [(u, i, float(rng.randint(1, 5))) for u in range(30) for i in range(12) if rng.random() < 0.5]
    df = spark.createDataFrame(data, "user_id long, item_id long, rating double")
    full = _brute_cosine(data)
    row = {r["item_id"]: (r["score"], r["n_pairs"]) for r in similarity.similarity_to(df, 0).collect()}
    want = {(b if a == 0 else a): v for (a, b), v in full.items() if 0 in (a, b)}
    assert row.keys() == want.keys()
    for k in want:
        assert row[k][1] == want[k][1] and abs(row[k][0] - want[k][0]) <= 1e-6


def _random_incidence(seed, nodes=60, groups=40):
    rng = random.Random(seed)
    inc = {(rng.randrange(nodes), g) for g in range(groups) for _ in range(rng.randint(1, 4))}
    inc |= {(rng.randrange(nodes), 0) for _ in range(15)}  # a large group
    return sorted(inc)


def _entries(inc):
    members = defaultdict(list)
    for n, g in inc:
        members[g].append(n)
    return [(a, b) for ms in members.values() for a in ms for b in ms if a != b]


def test_cooccurrence_degree_matches_pairs(spark):
    inc = _random_incidence(5)
    df = spark.createDataFrame(inc, "node long, grp long")
    got = {r["node"]: r["degree"] for r in graph.cooccurrence_degree(df).collect()}
    want = defaultdict(int)
    for n, _ in inc:
        want[n] += 0
    for a, _ in _entries(inc):
        want[a] += 1
    assert got == dict(want)


def test_cooccurrence_bfs_matches_entry_bfs(spark):
    inc = _random_incidence(9)
    inc_df = spark.createDataFrame(inc, "node long, grp long")
    ent_df = spark.createDataFrame(_entries(inc), "node long, neighbour long")
    a = {tuple(r) for r in graph.cooccurrence_bfs_distances(inc_df, inc[0][0], 4).collect()}
    b = {tuple(r) for r in graph.bfs_distances(ent_df, inc[0][0], 4).collect()}
    assert a == b
    for target in {n for n, _ in inc[:25]}:
        x = [tuple(r) for r in graph.cooccurrence_degrees_of_separation(inc_df, inc[0][0], target, 4).collect()]
        y = [tuple(r) for r in graph.degrees_of_separation(ent_df, inc[0][0], target, 4).collect()]
        assert x == y, target


def test_spread_keeps_rows(spark):
    from rankfold.functions import spread

    df = spark.range(100).coalesce(1)
    assert spread(df).agg(F.sum("id")).first()[0] == 4950


def test_sparse_cell_products_equal_dense(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    for trial in range(20):
        nu, ni, nj = rng.integers(1, 30), rng.integers(1, 12), rng.integers(1, 12)
        def side(n_items):
            mask = rng.random((nu, n_items)) < rng.uniform(0.05, 0.9)
            u, i = np.nonzero(mask)
            return u, i, rng.integers(0, 6, len(u)).astype(float)
        left, right = side(ni), side(nj)
        monkeypatch.setattr(similarity, "PAIR_CHUNK", int(rng.integers(1, 50)))
        dense = similarity._dense_products(np.arange(nu), left, right, ni, nj)
        sparse = similarity._sparse_products(nu, left, right, ni, nj)
        for a, b in zip(dense, sparse):
            assert np.allclose(a, b), trial


def test_block_similarity_sparse_path(spark, monkeypatch):
    monkeypatch.setattr(similarity, "DENSE_SPEEDUP", 0)   # always take the sparse path
    monkeypatch.setattr(similarity, "PAIR_CHUNK", 5)
    rng = random.Random(21)
    rows = {(u, i): float(rng.randint(0, 5)) for u in range(30) for i in range(20) if rng.random() < 0.2}
    data = [(u, i, r) for (u, i), r in rows.items()]
    df = spark.createDataFrame(data, "user_id long, item_id long, rating double")
    got = {(r["item1"], r["item2"]): (r["score"], r["n_pairs"])
           for r in similarity.item_similarity(df, items_per_block=6, users_per_block=9, light_user=0).collect()}
    want = _brute_cosine(data)
    assert got.keys() == want.keys()
    for k, (score, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - score) <= 1e-6, k


def test_bfs_with_hot_group_matches_brute_force(spark):
    # one group holds a third of all memberships; it is salted over several buckets
    rng = random.Random(17)
    inc = {(rng.randrange(90), g) for g in range(1, 60) for _ in range(rng.randint(1, 3))}
    inc |= {(n, 0) for n in range(0, 90, 1) if rng.random() < 0.8}
    inc = sorted(inc)
    inc_df = spark.createDataFrame(inc, "node long, grp long")
    ent_df = spark.createDataFrame(_entries(inc), "node long, neighbour long")
    start = inc[-1][0]
    probe = graph._Bucketed(inc_df, len(inc), "grp", "node", "probe", 20)
    members = sum(g == 0 for _, g in inc)
    assert [tuple(r) for r in probe.hot.collect()] == [(0, -(-members // 20))]
    probe.drop()
    a = {tuple(r) for r in graph.cooccurrence_bfs_distances(inc_df, start, rows_per_bucket=20).collect()}
    b = {tuple(r) for r in graph.bfs_distances(ent_df, start, rows_per_bucket=20).collect()}
    assert a == b


def test_bfs_reaches_the_end_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(13)]
    ent = spark.createDataFrame(chain + [(b, a) for a, b in chain], "node long, neighbour long")
    assert {r["node"]: r["dist"] for r in graph.bfs_distances(ent, 0).collect()} == {i: i for i in range(14)}
    assert [tuple(r) for r in graph.degrees_of_separation(ent, 0, 13).collect()] == [(13, 1)]
    assert graph.bfs_distances(ent, 0, max_levels=10).count() == 11
    assert graph.degrees_of_separation(ent, 0, 99).count() == 0


def test_light_and_heavy_users_together(spark):
    rng = random.Random(4)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(40) for i in range(25) if rng.random() < (0.9 if u % 5 == 0 else 0.15)}
    data = [(u, i, r) for (u, i), r in rows.items()]
    df = spark.createDataFrame(data, "user_id long, item_id long, rating double")
    want = _brute_cosine(data)
    for light in (0, 6, 1000):
        got = {(r["item1"], r["item2"]): (r["score"], r["n_pairs"])
               for r in similarity.item_similarity(df, items_per_block=6, users_per_block=9, light_user=light).collect()}
        assert got.keys() == want.keys()
        for k, (score, n) in want.items():
            assert got[k][1] == n and abs(got[k][0] - score) <= 1e-6, k

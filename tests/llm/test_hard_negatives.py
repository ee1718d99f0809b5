import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, n=5, m=3, low=50, high=95, scale=256):
    """All pairs, by the definition; rows are (id, vector, label)."""
    ok = {(i, lab, tuple(v)) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    ints = [(i, lab, v, [math.floor(scale * x) for x in v]) for i, lab, v in ok]
    out = []
    for a in (r for r in ints if is_anchor(r[0])):
        scored = sorted(((-sum(x * y for x, y in zip(a[3], r[3])), r[0], r) for r in ints if r is not a), key=lambda s: s[:2])
        for p in [s for s in scored if s[2][1] == a[1]][:n]:
            inside = [s for s in scored if s[2][1] != a[1] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(a[0], p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(inside[:m])]
    return sorted(out)


def mined(df, **more):
    out = hn.hard_negatives(df, F.col("label"), F.col("id") % 5 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def random_rows(seed, n, width, ties):
    rng = random.Random(seed)
    draw = (lambda: rng.choice((0.0, 0.25, 0.5))) if ties else (lambda: rng.uniform(-0.3, 1))
    return [(i, [draw() for _ in range(width)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("seed,n,width,ties", [(1, 120, 20, False), (2, 150, 3, True), (3, 90, 9, True), (4, 60, 1, False)])
def test_equals_brute_force(spark, seed, n, width, ties):
    rows = random_rows(seed, n, width, ties)
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and mined(df) == want
    # many small cells give the same
    assert mined(df, cell_rows=20 * width, cell_anchors=7 * width) == want


def test_scan_drops_candidates_before_the_end():
    """The bounds shrink the candidates of one anchor long before its last dimension."""
    rng = np.random.default_rng(0)
    columns = np.floor(256 * rng.normal(size=(64, 4000)) * np.exp(-np.arange(64) / 6)[:, None])
    anchor = np.floor(256 * np.exp(-np.arange(64) / 6))
    scan = hn.Scan(anchor, columns, columns.min(axis=1), columns.max(axis=1), np.arange(4000))
    left = []
    keep = scan.keep
    scan.keep = lambda alive: (keep(alive), left.append(len(scan.at)))
    hn.top(scan, 5)
    exact = anchor @ columns
    assert set(np.argsort(-exact)[:5]) <= set(scan.at) and left[2] < 200 and (scan.score == exact[scan.at]).all()
    spans = [(float(np.sort(exact)[-50]), float(np.sort(exact)[-20]))]
    scan = hn.Scan(anchor, columns, columns.min(axis=1), columns.max(axis=1), np.arange(4000))
    hn.windows(scan, spans, 3)
    inside = np.flatnonzero((exact >= spans[0][0]) & (exact <= spans[0][1]))
    assert set(inside[np.argsort(-exact[inside])[:3]]) <= set(scan.at) and len(scan.at) < 1000


def test_odd_rows(spark):
    vectors = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.4], 1), (3, [0.6, 0.4], 2), (3, [0.6, 0.3], 2),
        (4, None, 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1), (11, [0.7], 3), (12, [], 3), (10, [0.5, 0.25, 0.125], 3), (15, [-1.0, -1.0], 1)]
    df = spark.createDataFrame(vectors, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                                                      T.StructField("label", T.IntegerType())]))
    df = df.withColumn("mark", F.lit("x")).withColumn("anchor_id", F.lit(1)).withColumn("across", F.lit(2))
    got = mined(df)
    want = brute(vectors, lambda i: i % 5 == 0)
    assert got == want and {r[0] for r in got} == {0}
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id = 0")) == [] and mined(df.filter("vec_id % 5 <> 0")) == []


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2 ** 34 + 2 ** 12 * (i % 7)) * (1 if k % 2 else -1) if k < 1 else float(i % 3 + 1) for k in range(3)], i % 2) for i in range(40)]
    rows = [(i, [v[0] / 2 ** 13, v[1], v[2]], lab) for i, v, lab in rows]
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows, lambda i: i % 5 == 0)


def test_python_integers_beyond_2_53():
    table = pa.table({"id": [1, 2], "mark": [0, 0], "label": [1, 1], "vector": [[2.0 ** 22 + 1, 3.0], [2.0 ** 22 + 1, 2.0]]})
    table = table.append_column("anchor_vector", table["vector"])
    block, vectors = hn._prepared(table, table, 256.0)
    assert vectors.dtype == object
    scan = hn.Scan(vectors[0], block.columns, block.columns.min(axis=1), block.columns.max(axis=1), np.arange(2))
    hn.top(scan, 5)
    big = 256 * (2 ** 22 + 1)
    assert sorted(int(s) for s in scan.score) == sorted([big * big + 768 * 768, big * big + 768 * 512])
    assert list(itertools.islice(block.best(scan.at, scan.score, 1), 1)) == [int(np.argmax(scan.score))]

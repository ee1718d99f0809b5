from collections import defaultdict

import duckdb
import pytest
from brute import targets
from rankfold.llm import mix_threshold

SF = "/root/testdata/sf0.001"


def by_source(rows):
    out = defaultdict(lambda: [0, 0, None, 0])
    for r in rows:
        o = out[r.source]
        o[0], o[1], o[2], o[3] = o[0] + r["size"], o[1] + r.taken, r.target, max(o[3], r["size"])
    return out


@pytest.mark.parametrize("bits", [12, 2])
def test_targets_thresholds_and_caps(spark, bits):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), s) for i, s in enumerate(["big"] * 400 + ["mid"] * 60 + ["tiny"] * 5 + [None] * 9 + [""] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_threshold.mixture(docs, bits=bits).collect()
    groups = by_source(got)
    expected = targets({s: g[0] for s, g in groups.items()})
    for s, (size, taken, target, largest) in groups.items():
        assert target == pytest.approx(expected[s], rel=1e-12)
        assert abs(taken - target) <= largest / 2 + 1e-6
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert any(g[2] == 3 * g[0] for g in groups.values())  # the cap is reached
    again = mix_threshold.mixture(docs.repartition(7), bits=12).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_smaller_budgets_are_nested(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    small, large = ({r.doc_id for r in mix_threshold.mixture(docs, max_repeat=1, budget=b).collect() if r.times} for b in (0.2, 0.5))
    assert small and small < large


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = sorted((r.doc_id, r.taken) for r in mix_threshold.mixture(docs).collect())
    monkeypatch.setattr(mix_threshold, "BROADCAST_SOURCES", 0)
    assert a == sorted((r.doc_id, r.taken) for r in mix_threshold.mixture(docs).collect())


def test_odd_rows(odd_docs, no_docs):
    got = mix_threshold.mixture(odd_docs).collect()
    assert len(got) == 10 and {r.doc_id: r["size"] for r in got}[3] == 0
    assert all(r.target == 0 and r.taken == 0 for r in got if r.source_size == 0)
    mixed = mix_threshold.mixed_rows(odd_docs)
    assert mixed.columns == odd_docs.columns
    times = defaultdict(int)
    for r in mixed.collect():
        times[(r.doc_id, r.text)] += 1
    want = defaultdict(int)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in got:
        want[(r.doc_id, texts[r.doc_id])] += r.times
    assert times == {k: v for k, v in want.items() if v}
    assert mix_threshold.mixture(no_docs).count() == 0 and mix_threshold.mixed_rows(no_docs).count() == 0


def test_oracle_sql_with_a_capped_source(spark, tmp_path):
    rows = [(i, " ".join(["w"] * (1 + i * 5 % 17)), s) for i, s in enumerate(["a"] * 300 + ["b"] * 4 + [None] * 30 + ["d"] * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    frame = docs.toPandas()
    con.register("documents", frame)
    want = sorted(con.execute(mix_threshold.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in mix_threshold.mixture(docs).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == want

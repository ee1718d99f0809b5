import numpy as np
import pytest
from brute import components, simhash, simhash_groups
from pyspark.sql import functions as F
from rankfold.llm import simhash_trie
from rankfold.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def test_fingerprint_matches_brute_force_and_spark_hash(spark):
    texts = ["", None, "One", "one two THREE four five", "a b c", "É é  x\ty z", "w " * 300]
    assert [simhash_trie.fingerprint(t) for t in texts] == [simhash(t) for t in texts]
    signed = spark.sql("SELECT xxhash64('one two three four') AS h").first()[0]
    assert simhash_trie.fingerprint("one two three four") == signed % 2**64


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = simhash_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = simhash_trie.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == expected


@pytest.mark.parametrize("max_cell", [20_000, 60])
def test_dense_cluster_links_are_complete(spark, max_cell):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    near = {int(centre)} | {int(centre ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False)))) for k in (1, 2, 3, 5) for _ in range(80)}
    fps = sorted(near | {int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)})
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    pairs = connected_components(simhash_trie.links(rows, len(fps), max_cell=max_cell)).collect()
    got = {int(np.int64(r.node).view(np.uint64)): r.component for r in pairs}
    brute = components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 4])
    for a in fps:
        for b in fps:
            if brute[a] == brute[b] and a != b:
                assert got[a] == got[b]
    assert len(got) == sum(1 for f in fps if list(brute.values()).count(brute[f]) > 1)


def test_odd_rows(odd_docs, no_docs):
    got = simhash_trie.near_duplicates(odd_docs).select("doc_id", "fingerprint", "component_id").collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and by[3].fingerprint == "0" * 16
    assert by[3].component_id == by[4].component_id == by[5].component_id == 3
    assert by[None].component_id is None
    kept = simhash_trie.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (True, 0)]
    assert simhash_trie.near_duplicates(no_docs).count() == 0 and simhash_trie.one_per_group(no_docs).count() == 0


def test_repeated_representative_is_kept_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "a b c d e f", "y")], "doc_id long, text string, e string")
    assert [tuple(r) for r in simhash_trie.one_per_group(docs).collect()] == [(1, "a b c d e f", "x")]


def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    rows = spark.createDataFrame(chain + star + [(200, 200), (5, 5), (1, 0)], "u long, v long")
    got = {r.node: r.component for r in connected_components(rows).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(rows.filter(F.lit(False))).count() == 0

"""Invariants of registered queries on the small scale."""

from pyspark.sql import functions as F

from scales import SF_SMALL
from rankfold.plans import catalog
from rankfold.plans import testmap as tm


def test_similarity_pairs_ordered_and_bounded(spark):
    sims = catalog.QUERIES["item_similarity"](spark, SF_SMALL)
    bad = sims.filter((F.col("item1") >= F.col("item2")) | (F.abs("score") > 1 + 1e-9) | (F.col("n_pairs") < 1))
    assert bad.count() == 0 and sims.count() > 0


def test_split_counts_sum_to_total(spark):
    total = tm.ratings_unique_df(spark, SF_SMALL).count()
    for scheme in ("split_counts_68", "split_counts_24"):
        rows = {r["split"]: r["n"] for r in catalog.QUERIES[scheme](spark, SF_SMALL).collect()}
        assert set(rows) <= {"train", "validation", "test"} and sum(rows.values()) == total


def test_degrees_sum_matches_group_sizes(spark):
    inc = tm.incidence_df(spark, SF_SMALL)
    deg = catalog.QUERIES["node_degree"](spark, SF_SMALL).agg(F.sum("degree")).first()[0]
    want = inc.groupBy("grp").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0]
    assert deg == want


def test_tag_report_ratio_and_ranks(spark):
    rows = catalog.QUERIES["tag_popularity"](spark, SF_SMALL).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(r["ratio"] == r["n_ratings"] // r["n_items"] for r in rows)
    assert [r["n_ratings"] for r in rows] == sorted((r["n_ratings"] for r in rows), reverse=True)

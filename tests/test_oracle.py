"""Every registered query with an oracle matches DuckDB exactly (names, row count,
values) on the smallest scale; ``tests/run_oracle.py`` runs the same check at sf0.01."""

import pytest

import __spark_entry__ as entry
from scales import SF_SMALL
from oracle_compare import compare, duck

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, QUERIES, ORACLE, name, SF_SMALL, con)
    assert res["status"] == "match", res
    assert "type_diff" not in res, res


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "name", "n_ratings"]
    assert len(df.collect()) == 10

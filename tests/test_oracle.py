"""Every registered query against its DuckDB oracle, on the smallest tables."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _names():
    from __spark_entry__ import oracle_sql, queries
    return sorted(set(queries()) & set(oracle_sql()))


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql
    from winnow.plans.catalog import QUERIES
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_matches_duckdb(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    ok, msg = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_entry(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert [r["metric"] for r in rows] == ["pubmed", "scopus", "ieee", "total_raw", "duplicates_removed",
                                           "dedup_papers", "excluded_rev_conf", "kept"]

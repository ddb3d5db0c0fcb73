"""Every registered query beside its DuckDB SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.compare import compare, duckdb_connection
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(queries()) & set(oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, note = compare(spark, con, sf_dir, name)
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert "advantage" in df.columns and df.limit(1).count() == 1

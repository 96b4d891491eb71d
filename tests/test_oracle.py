"""Every core query equals its DuckDB oracle on the smallest scale factor.

The corpus operators, some of which SQL cannot express, have their own gate in
``tests/llm``.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from driftlens.plans.fixture_queries import QUERIES
from driftlens.plans.oracle import oracle_sql as core_sql
from oracle_compare import compare, duck

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(core_sql()) == set(QUERIES)


def test_entry_registers_all_of_them():
    assert set(QUERIES) <= set(queries())
    assert set(core_sql()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], core_sql()[name], SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert [f.name for f in df.schema.fields][:4] == ["config_id", "table_name", "column_name", "anamoly_id"]
    assert df.count() > 0

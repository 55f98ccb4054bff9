"""Every registered query against its DuckDB oracle on the driver's sf0.01 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from incentiva import oracle, registry
from conftest import SF_CHECK, SF_SMOKE
from oracle_compare import compare, duck_connection

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_CHECK)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_CHECK), con, ORACLE[name])
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r


# row counts read off the fixture parity table (FIXTURES.md section 4)
EXPECTED_ROWS = {
    "bonus_detail_old": 4439, "store_graduation_old": 832, "portfolio_totals_old": 49,
    "bonus_detail_new": 4488, "store_graduation_new": 818, "portfolio_totals_new": 50,
    "commission_tracker": 15491, "commission_tracker_all_stores": 21390,
}


@pytest.mark.parametrize("name, rows", sorted(EXPECTED_ROWS.items()))
def test_row_counts_at_sf001(spark, name, rows):
    assert QUERIES[name](spark, SF_CHECK).count() == rows


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["mentora", "orientador", "store_url", "leader_name", "dynamo_customer_id", "customer_name",
                          "total_cliente", "flag_bono", "falta"]
    assert df.count() == 533
    assert SF_SMOKE in entry_module.SMOKE_DIR

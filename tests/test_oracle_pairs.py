"""The correctness gate in miniature: registered queries against their DuckDB oracle SQL
on the sf0.001 tables (same column names, same multiset of rows)."""

import pytest

from conftest import SF_SMALL
from forgeline import registry
from forgeline.oracle import compare, duckdb_connection

PAIRS = ["stg_maintenance_events", "int_production_enriched", "mart_production_daily", "mart_quality_summary",
         "mart_machine_downtime", "loo_zscore", "quarantine_reason", "dedup_first_wins", "quarantine_json",
         "ingest_stats", "dq_report", "upsert_scores"]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", PAIRS)
def test_query_matches_oracle(spark, con, name):
    res = compare(registry.QUERIES[name](spark, SF_SMALL), con, registry.ORACLE[name])
    assert res["schema_match"] and res["rows_match"] and res["values_match"], res


@pytest.mark.parametrize("table", ["machines", "events", "maintenance"])
def test_csv_roundtrip_of_every_table(spark, con, table):
    name = f"csv_roundtrip_{table}"
    res = compare(registry.QUERIES[name](spark, SF_SMALL), con, registry.ORACLE[name])
    assert res["schema_match"] and res["rows_match"] and res["values_match"], res

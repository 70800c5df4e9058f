"""Registered queries beside their SQL statements. By default a slice of each module; FULL_SQL=1 compares all."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_sql import TABLES, differences

FOLDER = "/root/testdata/sf0.001"
SLICE = [
    "pair_spread_zscore", "fisher_momentum_zscore", "month_end_selection", "forward_outcomes", "asof_price", "peer_statistics", "candidate_selection", "derived_features", "solvency_gate", "history_features",
    "robust_trends", "source_row_audit", "report_date_audit", "keyed_upsert_counts", "content_snapshot_revisions", "streamed_monthly_values", "series_validation_report", "quantile_outcomes", "bootstrap_interval",
    "sentence_claims", "transcript_quality", "merged_documents", "annual_facts", "trailing_twelve_months", "ownership_form_trades", "guidance_outcomes", "commitment_outcomes", "current_states", "pillar_scores", "numbered_sources",
]
NAMES = sorted(oracle_sql()) if os.environ.get("FULL_SQL") else SLICE


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, database, name):
    assert differences(queries()[name](spark, FOLDER).toPandas(), database.execute(oracle_sql()[name]).df()) is None


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())

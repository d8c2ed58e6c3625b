"""Registered queries against their check SQL at the smallest scale; LEDGERLOOM_ALL=1 runs them all."""

import os

import duckdb
import pytest

import check
from ledgerloom.bridge import RAW_TABLES
from ledgerloom.catalog import CHECKS, PLANS, as_callables

import __spark_entry__ as spark_entry

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "f1_parse_jp_number", "f9_parse_jp_date", "f25_display_format", "a2_period_rows", "a4_period_index", "a5_latest_corrections",
    "j6_merge_three_sources", "a11_coverage_summary", "s12_record_normalizer", "w2_annual_series", "w3_quarterly_series", "v2_dcf",
    "a19_benchmarks", "v4_peer_comparison", "j1_security_master", "a13_inventory_matrix", "a14_gap_analysis", "w5_file_numbering",
    "j7_reconcile", "s11_structured_tables", "a26_harmonize_periods", "a28_indicators", "t1_split_paragraphs", "a18_risk_level_table",
    "w6_statement_spans", "t6_page_periods", "a24_best_candidate", "h2_ir_links", "h4_table_prices", "h5_state_news", "q2_key_coverage",
    "q14_gate_rollup", "d1_snapshot_diff", "s1_filing_index", "s5_statements", "s7_xbrl_facts", "s8_narrative_blocks", "st1_filing_stream",
    "st2_manifest_upsert", "r1_report_tables", "a31_statement_type_notes",
)
NAMES = sorted(PLANS) if os.environ.get("LEDGERLOOM_ALL") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in RAW_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = as_callables()[name](spark, SF)
    got = check.normal([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert got == check.normal(cursor.fetchall(), names)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_peer_comparison_keeps_companies_without_peers(spark, monkeypatch):
    from ledgerloom.catalog import records

    fields = "ticker string, metric string, target double, peer_median double, peer_average double, vs_median double, vs_average double"
    compared = [("1", "per", 2.0, 1.0, 1.0, 1.0, 1.0), ("2", "per", 3.0, None, None, None, None)]
    monkeypatch.setattr(records, "peer_comparison", lambda _: spark.createDataFrame(compared, fields))
    assert sorted(tuple(r) for r in records.v4(None).collect()) == compared

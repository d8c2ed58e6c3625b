"""The three end-to-end chains as plain function composition; Catalyst plans each as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import facts as facts_ops
from ledgerloom.operators import merge, reconcile, records
from ledgerloom.operators.ranking import running_position
from ledgerloom.rules.concepts import RECORD_FIELDS


def period_table(facts: DataFrame, contexts: DataFrame, securities: DataFrame, leave_out: Sequence[str] = ()) -> DataFrame:
    """Facts to completed period rows with the company's fiscal month and an ingest order.

    The order counts a company's documents by id and their periods by date. It is worked out from the
    period rows, of which a document has a handful, and which are written for that: columns that nothing
    reads later can be named in ``leave_out``.
    """
    periods = facts_ops.derive_totals(facts_ops.period_rows(facts, contexts)).join(
        securities.select("ticker", "fye_month"), "ticker", "left"
    ).drop(*leave_out)
    return running_position(
        periods.withColumn("statement_type", F.lit("consolidated")), ["ticker"], [F.substring("document_id", 1, 12)],
        [F.col("document_id"), F.col("period_end")], "seq",
    )


def integrated_series(periods: DataFrame, statements: DataFrame, web: DataFrame | None = None) -> DataFrame:
    """Filings, statements and web rows to one series per company."""
    return merge.merge_entries(
        merge.filing_entries(periods), merge.statement_entries(statements), None if web is None else merge.web_entries(web)
    )


def metric_tables(integrated: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Integrated entries to annual series, quarterly series and latest snapshot."""
    rows = integrated.select(
        "ticker", F.lit(None).cast("string").alias("company_name"), "fiscal_year", F.col("quarter").alias("period"),
        "period_start", "period_end", F.lit(0).cast("bigint").alias("seq"),
        *[
            (F.coalesce("total_equity", "net_assets") if f == "equity" else F.col(f)).cast("double").alias(f)
            for f in RECORD_FIELDS
        ],
        F.lit(False).alias("provisional"), "statement_type",
    )
    kept = records.dedup_records(rows)
    annual = records.annual_series(kept)
    return annual, records.quarterly_series(kept), records.latest_snapshot(annual)


def reconciliation(filings: DataFrame, statements: DataFrame, tolerance: float = reconcile.TOLERANCE) -> DataFrame:
    """Period figures of two sources to verdicts."""
    usable = reconcile.drop_all_null(statements)
    return reconcile.reconcile(
        reconcile.richest_entry(filings, ["document_id"]), reconcile.richest_entry(usable, ["type_of_current_period"]), tolerance
    )

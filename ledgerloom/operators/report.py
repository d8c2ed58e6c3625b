"""The report's tables as rows with display text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.display import MONETARY_FIELDS, display_value, fiscal_year_display, fixed_decimals, statement_label

# Lines of the latest figures with their unit suffix, and columns of the series tables.
LATEST_FIELDS = {
    "revenue": "", "operating_income": "", "net_income": "", "roe_percent": "%", "roa_percent": "%",
    "operating_margin_percent": "%", "equity_ratio_percent": "%", "free_cash_flow": "",
}
QUARTERLY_FIELDS = (
    "revenue", "operating_income", "net_income", "operating_margin_percent", "revenue_growth_yoy_percent",
    "profit_growth_yoy_percent",
)
PROVISIONAL_MARK = " [暫定]"


def with_absences(series: DataFrame, absences: DataFrame) -> DataFrame:
    """Series rows with the set of fields known to be absent in their fiscal year."""
    fields = absences.groupBy("ticker", "fiscal_year").agg(F.collect_set("field").alias("absent"))
    return series.join(fields, ["ticker", "fiscal_year"], "left").withColumn(
        "absent", F.coalesce("absent", F.array().cast("array<string>"))
    )


def _cell(name: str, number_format: str, suffix: str = "") -> Column:
    return display_value(
        F.col(name), number_format, monetary=name in MONETARY_FIELDS, absent=F.array_contains("absent", F.lit(name)), suffix=suffix
    ).alias(name)


def annual_table(series: DataFrame, number_format: str = "raw") -> DataFrame:
    """One display row per fiscal year; ``series`` comes from `with_absences`."""
    year = fiscal_year_display(F.col("fiscal_year"), F.col("period_months"))
    return series.select(
        "ticker", "position",
        F.when(F.col("provisional"), F.concat(year, F.lit(PROVISIONAL_MARK))).otherwise(year).alias("fiscal_year"),
        statement_label(F.col("statement_type")).alias("statement"),
        *[_cell(f, number_format) for f in LATEST_FIELDS],
    )


def latest_table(snapshots: DataFrame, number_format: str = "raw") -> DataFrame:
    """One line per latest figure."""
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("line"), F.lit(f).alias("field"), _cell(f, number_format, suffix).alias("text"))
            for i, (f, suffix) in enumerate(LATEST_FIELDS.items())
        ]
    )
    return snapshots.select("ticker", "provisional", F.explode(lines).alias("l")).select("ticker", "provisional", "l.*")


def quarterly_table(series: DataFrame, number_format: str = "raw") -> DataFrame:
    year = F.coalesce(F.col("fiscal_year").cast("string"), F.lit("N/A"))
    rows = series.withColumn("absent", F.array().cast("array<string>"))
    return rows.select(
        "ticker", F.concat(year, F.when(F.col("provisional"), PROVISIONAL_MARK).otherwise("")).alias("fiscal_year"), "period",
        *[_cell(f, number_format) for f in QUARTERLY_FIELDS],
    )


def valuation_table(valued: DataFrame, multiples: DataFrame) -> DataFrame:
    """Values in hundred millions and multiples as text."""
    def text(c: Column, digits: int, grouped: bool = True) -> Column:
        return F.when(c.isNotNull(), fixed_decimals(c, digits, grouped)).otherwise("N/A")

    joined = valued.join(multiples, "ticker", "left")
    hundred_million = lambda name: text(F.col(name) / 1e8, 1)
    return joined.select(
        "ticker", hundred_million("enterprise_value").alias("enterprise_value"), hundred_million("equity_value").alias("equity_value"),
        text(F.col("per_share_value"), 0).alias("per_share_value"),
        *[text(F.col(m), 2, grouped=False).alias(m) for m in ("per", "pbr", "ev_ebitda")],
    )


def statement_type_notes(annual: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Years by statement type, provisional years and whether the type changes, per company.

    The annual and quarterly rows are reduced to one row per company before they meet.
    """
    kind = lambda name: F.array_sort(F.collect_set(F.when(F.col("statement_type") == name, F.col("fiscal_year"))))
    provisional = lambda df: df.filter("provisional").select("ticker", "fiscal_year")
    years = annual.groupBy("ticker").agg(kind("standalone").alias("standalone"), kind("consolidated").alias("consolidated"))
    marked = provisional(annual).union(provisional(quarterly)).groupBy("ticker").agg(
        F.array_sort(F.collect_set("fiscal_year")).alias("provisional")
    )
    listed = lambda arr: F.array_join(F.transform(arr, lambda y: F.concat(F.lit("FY"), y.cast("string"))), ", ")
    c = F.col
    span = F.concat(F.lit("FY"), F.array_min("consolidated").cast("string"), F.lit("-FY"), F.array_max("consolidated").cast("string"))
    return years.join(marked, "ticker", "left").select(
        "ticker",
        F.when(F.size("standalone") > 0, F.concat(listed(c("standalone")), F.lit(" は単体（standalone）財務諸表"))).alias("standalone_note"),
        F.when(
            F.size("consolidated") > 0,
            F.concat(F.when(F.size("consolidated") > 2, span).otherwise(listed(c("consolidated"))), F.lit(" は連結（consolidated）財務諸表")),
        ).alias("consolidated_note"),
        F.coalesce(listed(c("provisional")), F.lit("")).alias("provisional_years"),
        ((F.size("standalone") > 0) & (F.size("consolidated") > 0)).alias("type_changed"),
    )


def source_details(merged: DataFrame) -> DataFrame:
    """Documents with their period end, and disclosure dates per period; the later entry counts."""
    c = F.col
    documents = merged.filter(c("document_id").isNotNull()).groupBy("ticker", c("document_id").alias("key")).agg(
        F.max(F.struct("fiscal_year", "quarter", "period_end"))["period_end"].alias("value")
    )
    dates = merged.filter(c("jquants_disclosed_date").isNotNull() & c("period_end").isNotNull()).groupBy(
        "ticker", c("period_end").cast("string").alias("key")
    ).agg(F.max(F.struct("fiscal_year", "quarter", "jquants_disclosed_date"))["jquants_disclosed_date"].alias("value"))
    return documents.withColumn("source", F.lit("edinet")).unionByName(dates.withColumn("source", F.lit("jquants")))

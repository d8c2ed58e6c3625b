"""Merging filings, earnings statements and web figures into one series per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import fiscal_year, period_kind, quarter_label
from ledgerloom.functions.numbers import non_null_count
from ledgerloom.rules.concepts import BS_FIELDS, PL_FIELDS

# Fields of a merged entry and of each source's entry.
MERGE_FIELDS = (
    "total_assets", "current_assets", "noncurrent_assets", "total_liabilities", "current_liabilities",
    "total_equity", "net_assets", "revenue", "gross_profit", "operating_income", "ordinary_income", "net_income",
    "operating_cf", "investing_cf", "financing_cf", "free_cash_flow",
)
STATEMENT_FIELDS = (
    "total_assets", "total_equity", "net_assets", "revenue", "operating_income", "ordinary_income",
    "net_income", "operating_cf",
)
WEB_FIELDS = ("revenue", "gross_profit", "operating_income", "ordinary_income", "net_income")
RICHNESS_FIELDS = ("revenue", "operating_income", "net_income", "total_assets")
SOURCES = ("edinet", "web", "jquants")


def enough_facts(periods: DataFrame, minimum: int = 2) -> DataFrame:
    """Periods with at least ``minimum`` known balance-sheet and income figures."""
    fields = [f for f in BS_FIELDS + PL_FIELDS if f in periods.columns]
    return periods.filter(non_null_count(*[F.col(f) for f in fields]) >= minimum)


def with_period_keys(rows: DataFrame) -> DataFrame:
    end, fye = F.col("period_end"), F.col("fye_month")
    return rows.withColumn("fiscal_year", fiscal_year(end, fye)).withColumn("quarter", quarter_label(end, fye))


# Attributes of an entry beside its figures.
ATTRIBUTES = {
    "period_end": "date", "period_start": "date", "document_id": "string", "statement_type": "string",
    "disclosed_date": "date", "web_source": "string",
}
KEYS = ["ticker", "fiscal_year", "quarter"]


def _candidates(rows: DataFrame, source: str, richness: Column, place: Column) -> DataFrame:
    """Rows of one source in the common shape; the greatest (richness, place) of a key is its entry."""
    cols = {**ATTRIBUTES, **dict.fromkeys(MERGE_FIELDS, "bigint"), "eps": "double"}
    shaped = [(F.col(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in cols.items()]
    return rows.select(
        *KEYS, F.lit(source).alias("source"),
        F.struct(richness.cast("int").alias("richness"), place.cast("bigint").alias("place")).alias("order"),
        F.struct(*shaped).alias("entry"),
    )


def filing_entries(periods: DataFrame) -> DataFrame:
    """Annual and quarterly candidates of filings.

    Of annual rows the last one counts, of quarterly rows the richest one and then the first. Short
    periods that end in the fiscal month belong to neither.
    """
    kind = period_kind(F.col("period_end"), F.col("period_start"), F.col("fye_month"))
    rows = with_period_keys(enough_facts(periods)).filter((kind == "annual") | (F.col("quarter") != "FY"))
    annual = F.col("quarter") == "FY"
    return _candidates(
        rows, "edinet", F.when(annual, 0).otherwise(non_null_count(*[F.col(f) for f in RICHNESS_FIELDS])),
        F.when(annual, F.col("seq")).otherwise(-F.col("seq")),
    )


def statement_entries(statements: DataFrame) -> DataFrame:
    """Candidates of earnings statements: the last annual one, the first of each quarter."""
    rows = with_period_keys(statements.filter(F.col("period_end").isNotNull()))
    known = [*KEYS, "period_end", "period_start", "disclosed_date", *STATEMENT_FIELDS, "seq"]
    place = F.when(F.col("quarter") == "FY", F.col("seq")).otherwise(-F.col("seq"))
    return _candidates(rows.select(*known), "jquants", F.lit(0), place)


def web_entries(web: DataFrame) -> DataFrame:
    """Annual web candidates: they need a period end, and the first row of a fiscal year counts."""
    fy = F.coalesce("fiscal_year", fiscal_year(F.col("period_end"), F.col("fye_month")))
    rows = (
        web.filter(F.col("period_end").isNotNull())
        .withColumn("fiscal_year", fy).withColumn("quarter", F.lit("FY"))
    )
    known = [*KEYS, "period_end", "web_source", *WEB_FIELDS, "eps", "seq"]
    return _candidates(rows.select(*known), "web", F.lit(0), -F.col("seq"))


def pick_entries(candidates: DataFrame) -> DataFrame:
    """The entry of each source and key."""
    return (
        candidates.groupBy(*KEYS, "source").agg(F.max_by("entry", "order").alias("e")).select(*KEYS, "source", "e.*")
    )


def merge_entries(filings: DataFrame, statements: DataFrame, web: DataFrame | None = None) -> DataFrame:
    """Merge by company, fiscal year and quarter: filings first, then web, then earnings statements.

    The candidates of all sources are put together and grouped once: the same aggregation chooses each
    source's entry and merges them, so there is one shuffle and no outer join.
    """
    stacked = filings.unionByName(statements)
    if web is not None:
        stacked = stacked.unionByName(web)
    entry = lambda s: F.max_by("entry", F.when(F.col("source") == s, F.col("order"))).alias(s)
    merged = stacked.groupBy(*KEYS).agg(*[entry(s) for s in SOURCES])
    has = {s: F.col(s).isNotNull() for s in SOURCES}
    joined = F.concat_ws("+", *[F.when(has[s], s) for s in SOURCES])
    label = F.when(~has["web"] & has["edinet"] & has["jquants"], "both").otherwise(joined)
    # The attributes of an entry come from its leading source, even where they are null there.
    leading = F.coalesce(*[F.col(s) for s in SOURCES])
    first_of = lambda n: F.coalesce(*[F.col(f"{s}.{n}") for s in SOURCES])
    columns = [
        *KEYS, *[leading[n].alias(n) for n in ("period_end", "period_start", "statement_type")],
        F.col("edinet.document_id").alias("document_id"), label.alias("source"),
        F.when(has["edinet"] | has["web"], F.col("jquants.disclosed_date")).alias("jquants_disclosed_date"),
        *[first_of(n).alias(n) for n in MERGE_FIELDS],
    ]
    if web is not None:
        columns += [F.col("web.web_source").alias("web_source"), F.col("web.eps").alias("eps")]
    return merged.select(*columns)


def coverage_summary(merged: DataFrame) -> DataFrame:
    """Per fiscal year: source of the annual row, its quarters and sources, and a one-line rule."""
    annual = F.max(F.when(F.col("quarter") == "FY", F.col("source")))
    quarters = F.array_sort(F.collect_set(F.when(F.col("quarter") != "FY", F.col("quarter"))))
    sources = F.array_sort(F.collect_set("source"))
    quoted = lambda arr: F.concat(F.lit("['"), F.array_join(arr, "', '"), F.lit("']"))
    return (
        merged.groupBy("ticker", "fiscal_year")
        .agg(annual.alias("annual"), quarters.alias("quarters"), sources.alias("sources"))
        .withColumn(
            "rule",
            F.concat_ws(
                ", ",
                F.when(F.col("annual").isNotNull(), F.concat(F.lit("annual="), "annual")),
                F.when(F.size("quarters") > 0, F.concat(F.lit("quarters="), quoted(F.col("quarters")))),
                F.concat(F.lit("sources="), quoted(F.col("sources"))),
            ),
        )
    )


def coverage_matrix(merged: DataFrame) -> DataFrame:
    """One row per merged period with its source and statement type."""
    return merged.select(
        "ticker", "period_end", "fiscal_year", "quarter", "source",
        F.when(F.col("source") == "jquants", "consolidated").otherwise(F.col("statement_type")).alias("statement_type"),
        "document_id",
    )


def source_keys(*frames: DataFrame) -> DataFrame:
    """Distinct keys of all sources."""
    keys = ["ticker", "fiscal_year", "quarter"]
    out = frames[0].select(*keys)
    for f in frames[1:]:
        out = out.union(f.select(*keys))
    return out.distinct()

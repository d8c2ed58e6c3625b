"""Inventory of collected documents: manifests, coverage, gaps and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import HALF_YEAR_RULE_START, filing_kind, fiscal_year, quarter_start
from ledgerloom.functions.numbers import round_to
from ledgerloom.operators.ranking import running

KINDS = ("q1", "q2", "q3", "h1", "annual")
# Metrics of the quality summary.
QUALITY_METRICS = (
    "revenue", "operating_income", "net_income", "total_assets", "total_equity", "net_assets", "operating_cf",
    "total_liabilities",
)
# Reasons of gaps.
GAP_REASONS = {
    "rule_change": "四半期報告書制度廃止 (2024年4月施行)",
    "no_half_year": "半期報告書が未収集",
    "first_year": "収集対象期間の開始年度",
    "latest_year": "最新年度 (未発表の可能性)",
    "missing": "存在すべきだが欠損",
}


def latest_manifest(manifests: DataFrame) -> DataFrame:
    """Per document the row of the newest collection run, the first in file order on ties.

    First the first row of every run, then the newest run: two small aggregations instead of a sort of
    all rows of a document.
    """
    others = [c for c in manifests.columns if c not in ("ticker", "doc_id")]
    per_run = (
        manifests.filter(F.col("doc_id").isNotNull())
        .groupBy("ticker", "doc_id", F.coalesce("fetched_at", F.lit("")).alias("run"))
        .agg(F.min(F.struct("source_file", "seq", *[F.col(c) for c in others if c not in ("source_file", "seq")])).alias("r"))
    )
    return (
        per_run.groupBy("ticker", "doc_id").agg(F.max(F.struct("run", "r"))["r"].alias("r"))
        .select("ticker", "doc_id", *[F.col(f"r.{c}").alias(c) for c in others])
    )


def current_period(periods: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Per document the period to show: the one ending on the target date, else the newest with a start."""
    started = periods.filter(F.col("period_start").isNotNull())
    if targets is not None:
        started = started.join(targets, ["ticker", "document_id"])
        match = F.coalesce(F.col("period_end") == F.col("target_end"), F.lit(False)).cast("int")
    else:
        match = F.lit(0)
    others = [c for c in periods.columns if c not in ("ticker", "document_id")]
    order = F.struct(match.alias("match"), "period_end", (-F.col("seq")).alias("place"))
    return (
        started.groupBy("ticker", "document_id")
        .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("r"))
        .select("ticker", "document_id", "r.*")
    )


def manifest_documents(manifests: DataFrame, periods: DataFrame, securities: DataFrame) -> DataFrame:
    """Manifest rows with their parsed period, filing kind and fiscal year; rows without a date drop out. A company that the
    master lacks keeps its rows, without fiscal month and what follows from it."""
    rows = latest_manifest(manifests).withColumn("manifest_end", F.substring("period_end", 1, 10).try_cast("date"))
    rows = rows.filter(F.col("manifest_end").isNotNull())
    targets = rows.select("ticker", F.col("doc_id").alias("document_id"), F.col("manifest_end").alias("target_end"))
    found = current_period(periods, targets).select(
        "ticker", F.col("document_id").alias("doc_id"), F.col("period_end").alias("parsed_end"), "period_start", "company_name"
    )
    end = F.coalesce("parsed_end", "manifest_end")
    return (
        rows.join(found, ["ticker", "doc_id"], "left")
        .join(securities.select("ticker", "fye_month"), "ticker", "left")
        .select(
            "ticker", "doc_id", "fye_month", end.alias("period_end"), "period_start", "company_name", "source_file", "fetched_at",
            filing_kind(end, F.col("period_start"), F.col("fye_month")).alias("period_type"),
            fiscal_year(end, F.col("fye_month")).alias("fiscal_year"), "seq",
        )
    )


def inventory_matrix(documents: DataFrame, statements: DataFrame | None = None) -> DataFrame:
    """Per company and fiscal year the first document of each kind, and the number of statements."""
    cell = lambda kind: F.min(F.when(F.col("period_type") == kind, F.struct("period_end", "seq", "doc_id")))["doc_id"]
    matrix = documents.filter(F.col("period_type").isin(*KINDS)).groupBy("ticker", "fye_month", "fiscal_year").agg(
        *[cell(k).alias(k) for k in KINDS]
    )
    if statements is None:
        return matrix
    counts = (
        statements.filter(F.col("fy_end").isNotNull())
        .groupBy("ticker", "fye_month", fiscal_year(F.col("fy_end"), F.col("fye_month")).alias("fiscal_year"))
        .agg(F.count("*").alias("statements"))
    )
    return matrix.join(counts, ["ticker", "fye_month", "fiscal_year"], "full_outer")


def statement_labels(statements: DataFrame) -> DataFrame:
    """The statements listed in each cell of the inventory, as rows with their place in it.

    Rows instead of one joined text: a company with very many statements is then numbered in pieces
    and never gathered in one value.
    """
    rows = statements.filter(F.col("fy_end").isNotNull()).select(
        "ticker", fiscal_year(F.col("fy_end"), F.col("fye_month")).alias("fiscal_year"), "seq",
        F.concat_ws(" ", F.col("TypeOfCurrentPeriod"), F.nullif("DisclosedDate", F.lit(""))).alias("label"),
    )
    return running(rows, ["ticker", "fiscal_year"], [F.col("seq").asc()], position="position")


def analyze_gaps(matrix: DataFrame) -> DataFrame:
    """Missing quarters and annual reports, as acceptable or actionable, with the reason.

    The expected cells are an array on each matrix row, so no grid is joined. The first and last year
    come from a group per company, combined before the shuffle.
    """
    years = matrix.groupBy("ticker").agg(F.min("fiscal_year").alias("first_fy"), F.max("fiscal_year").alias("last_fy"))
    rows = matrix.join(years, "ticker")
    c = F.col
    rule_start = F.lit(HALF_YEAR_RULE_START).cast("date")
    gap = lambda level, label, reason: F.struct(
        F.lit(level).alias("level"), F.lit(label).alias("quarter"), F.lit(GAP_REASONS[reason]).alias("reason")
    )

    def quarter_gap(q: str) -> Column:
        new_rule = quarter_start(c("fiscal_year"), c("fye_month"), F.lit(q)) >= rule_start
        before = F.when(c("fiscal_year") == c("first_fy"), gap("acceptable", q.upper(), "first_year")).otherwise(
            gap("actionable", q.upper(), "missing")
        )
        after = (
            F.when(c("h1").isNull(), gap("actionable", "H1", "no_half_year"))
            if q == "q2" else gap("acceptable", q.upper(), "rule_change")
        )
        return F.when(c(q).isNull(), F.when(new_rule, after).otherwise(before))

    annual_gap = F.when(
        c("annual").isNull(),
        F.when(c("fiscal_year") == c("last_fy"), gap("acceptable", "有報", "latest_year"))
        .when(c("fiscal_year") == c("first_fy"), gap("acceptable", "有報", "first_year"))
        .otherwise(gap("actionable", "有報", "missing")),
    )
    cells = F.array_compact(F.array(*[quarter_gap(q) for q in ("q1", "q2", "q3")], annual_gap))
    return rows.select("ticker", "fiscal_year", F.explode(cells).alias("g")).select("ticker", "fiscal_year", "g.*")


def quality_summary(periods: DataFrame) -> DataFrame:
    """Known share of each metric over the documents' current periods, per company."""
    counted = current_period(periods).groupBy("ticker").agg(
        F.count("*").alias("total"), *[F.count(m).alias(m) for m in QUALITY_METRICS]
    )
    return counted.unpivot(["ticker", "total"], list(QUALITY_METRICS), "metric", "known").select(
        "ticker", "metric", "total", "known", (F.col("known") / F.col("total")).alias("ratio")
    )


def doc_type_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("ticker", "period_type").agg(
        F.count("*").alias("documents"), F.countDistinct("fiscal_year").alias("fiscal_years")
    )


def number_documents(documents: DataFrame) -> DataFrame:
    """Running number of a company's documents by period end and ingest order.

    The documents are dealt out by measured ranges of company, period end and order, so numbers that lie close together and far
    apart give equal shares, and what is computed before is computed once.
    """
    return running(documents, ["ticker"], [F.col("period_end").asc(), F.col("seq").asc()], position="number")


def collection_stats(manifests: DataFrame) -> DataFrame:
    """Attempted, downloaded, skipped and failed documents per company, with coverage ratios."""
    n = lambda s: F.count_if(F.col("status") == s)
    counts = manifests.groupBy("ticker").agg(
        F.count("*").alias("attempted"), n("downloaded").alias("downloaded"), n("skipped_existing").alias("skipped_existing"),
        n("failed").alias("failed"), (F.datediff(F.max("list_date"), F.min("list_date")) + 1).alias("calendar_days"),
    )
    ratio = lambda part: round_to(part / F.col("attempted"), 4)
    return counts.select(
        "*", ratio(F.col("downloaded")).alias("coverage_ratio"),
        ratio(F.col("downloaded") + F.col("skipped_existing")).alias("effective_coverage_ratio"),
    )


DOC_ID_SHAPE = r"^[A-Za-z0-9_\-]+$"


def target_filings(
    filings: DataFrame, keyword: str = "有価証券報告書", edinet_code: str | None = None, security_code: str | None = None,
    form_codes: list[str] | None = None, doc_types: list[str] | None = None, require_xbrl: bool = True,
) -> DataFrame:
    """Filings that meet every given condition; all of them are plain predicates for the scan."""
    out = filings.filter(F.contains("docDescription", F.lit(keyword)) & F.col("docID").rlike(DOC_ID_SHAPE))
    for name, value in (("edinetCode", edinet_code), ("secCode", security_code)):
        if value is not None:
            out = out.filter(F.trim(name) == value)
    for name, values in (("formCode", form_codes), ("docTypeCode", doc_types)):
        if values is not None:
            out = out.filter(F.trim(name).isin(*values))
    if require_xbrl:
        out = out.filter(F.lower("xbrlFlag").isin("1", "true"))
    return out


def shares_outstanding(statements: DataFrame) -> DataFrame:
    """Issued less treasury shares of the latest statement, as text; empty when there is no usable number."""
    from ledgerloom.functions.numbers import strip, to_double

    latest = statements.groupBy("ticker").agg(F.max_by(F.struct("issued", "treasury"), "seq").alias("r"))
    issued, treasury = to_double(strip(F.col("r.issued"))), to_double(strip(F.col("r.treasury")))
    net = issued - F.coalesce(treasury, F.lit(0.0))
    return latest.select(
        "ticker",
        F.coalesce(F.when(net > 0, net).otherwise(issued).cast("bigint").cast("string"), F.lit("")).alias("shares"),
    )

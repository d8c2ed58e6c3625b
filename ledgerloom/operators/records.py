"""Financial records: normalising, de-duplicating and turning them into metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.dates import period_months
from ledgerloom.functions.numbers import (
    coerce_number, growth_percent, let, non_null_count, ratio_percent, round2, strip, sum_nullable,
)
from ledgerloom.rules.concepts import RECORD_FIELDS, alias_key

# Names under which each record field may appear, in order, with its section.
RECORD_ALIASES = {
    "revenue": ("pl", ("revenue", "net_sales", "sales", "売上高", "売上収益")),
    "operating_income": ("pl", ("operating_income", "operating_profit", "営業利益")),
    "net_income": ("pl", ("net_income", "profit", "profit_attributable_to_owners_of_parent",
                          "親会社株主に帰属する当期純利益", "当期純利益")),
    "total_assets": ("bs", ("total_assets", "assets", "資産合計", "総資産")),
    "equity": ("bs", ("equity", "total_equity", "net_assets", "自己資本", "純資産", "純資産合計")),
    "operating_cf": ("cf", ("operating_cf", "cash_flow_from_operating_activities", "営業活動によるキャッシュフロー")),
    "investing_cf": ("cf", ("investing_cf", "cash_flow_from_investing_activities", "投資活動によるキャッシュフロー")),
}

ANNUAL_PERIODS = ("FY", "MIXED", "DURATION", "INSTANT", "N/A", "")
QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def pick_number(section: Column, record: Column, aliases: list[str] | tuple[str, ...]) -> Column:
    """First alias with a numeric text in the section map, else in the whole record map.

    Keys are compared in lower case without punctuation; of equal keys the first entry counts.
    """
    def keyed(m: Column) -> Column:
        entries = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(entries, lambda e: F.struct(alias_key(e["key"]).alias("k"), e["value"].alias("v")))

    def first_value(entries: Column, alias: str) -> Column:
        return F.get(F.filter(entries, lambda e: e["k"] == alias_key(F.lit(alias))), F.lit(0))["v"]

    def search(entries: Column) -> Column:
        return F.coalesce(*[coerce_number(first_value(entries, a)) for a in aliases])

    return F.coalesce(let(keyed(section), search), let(keyed(record), search))


def _text(c: Column) -> Column:
    """Trimmed text, null when empty."""
    return F.nullif(strip(c), F.lit(""))


PERIOD_TYPE = (
    "struct<period_end:string,period_start:string,period_type:string,period:string,quarter:string,"
    "fiscal_year:string,provisional:boolean,statement_type:string,"
    "bs:map<string,string>,pl:map<string,string>,cf:map<string,string>,extra:map<string,string>>"
)
PAYLOAD_SCHEMA = (
    f"ticker string, company_name string, periods array<{PERIOD_TYPE}>, "
    f"documents array<struct<ticker:string,company_name:string,periods:array<{PERIOD_TYPE}>>>, "
    f"period_index array<{PERIOD_TYPE}>, annual array<{PERIOD_TYPE}>, quarterly array<{PERIOD_TYPE}>, flat {PERIOD_TYPE}"
)


def normalize_records(payloads: DataFrame, ticker_column: str = "file_ticker") -> DataFrame:
    """Flat records of payload rows in any of the known nestings.

    All nestings of a payload are brought to one array, so that each payload is read once. A flat
    payload counts only when no nesting has entries and it carries a fiscal year. Payloads of another
    ticker than the one of their folder are left out.
    """
    empty = F.array().cast("array<struct<ticker:string,company_name:string,period:string,p:" + PERIOD_TYPE + ">>")
    own, name, folder = _text(F.col("ticker")), _text(F.col("company_name")), F.col(ticker_column)

    def entry(p: Column, ticker: Column, company: Column, period: Column) -> Column:
        return F.struct(
            F.coalesce(ticker, folder).alias("ticker"), company.alias("company_name"), period.alias("period"), p.alias("p")
        )

    typed = lambda p: F.coalesce(_text(p["period_type"]), _text(p["period"]), F.lit("FY"))
    of_periods = lambda arr, ticker, company: F.transform(arr, lambda p: entry(p, ticker, company, typed(p)))
    lists = [
        of_periods(F.col("periods"), own, name),
        F.flatten(
            F.transform(
                F.col("documents"),
                lambda d: F.coalesce(of_periods(d["periods"], _text(d["ticker"]), _text(d["company_name"])), empty),
            )
        ),
        of_periods(F.col("period_index"), own, name),
        F.transform(F.col("annual"), lambda p: entry(p, own, name, F.lit("FY"))),
        F.transform(F.col("quarterly"), lambda p: entry(p, own, name, F.coalesce(_text(p["quarter"]), F.lit("Q")))),
    ]
    nested = F.concat(*[F.coalesce(x, empty) for x in lists])
    flat = F.when(
        coerce_number(F.col("flat.fiscal_year")).isNotNull(),
        F.array(entry(F.col("flat"), own, name, _text(F.col("flat.period")))),
    ).otherwise(empty)
    exploded = payloads.select(
        folder.alias("folder"), F.posexplode(F.when(F.size(nested) > 0, nested).otherwise(flat)).alias("pos", "e")
    ).filter(F.col("e.ticker") == F.col("folder"))
    p = F.col("e.p")
    whole = p["extra"]
    return exploded.select(
        "e.ticker", "e.company_name", "e.period", "pos",
        F.nullif(coerce_number(p["fiscal_year"]).cast("int"), F.lit(0)).alias("fiscal_year"),
        _text(p["period_end"]).alias("period_end"), _text(p["period_start"]).alias("period_start"),
        F.coalesce(p["provisional"], F.lit(False)).alias("provisional"),
        _text(p["statement_type"]).alias("statement_type"),
        *[pick_number(p[section], whole, names).alias(f) for f, (section, names) in RECORD_ALIASES.items()],
    )


def period_group(period: Column) -> Column:
    upper = F.upper(F.coalesce(period, F.lit("")))
    return F.when(upper.isin(*QUARTERS), upper).otherwise("FY")


def dedup_records(records: DataFrame) -> DataFrame:
    """One record per company, fiscal year and period group.

    Most known figures first, then mixed, duration, instant, then the newest period end, then the
    first record. Copies of a record rank equal to it, so they need no pass of their own.
    """
    kind = F.lower("period")
    rank = F.struct(
        non_null_count(*[F.col(f) for f in RECORD_FIELDS]).alias("known"),
        F.when(kind == "mixed", 2).when(kind == "duration", 1).when(kind == "instant", 0).otherwise(-1).alias("kind"),
        F.coalesce(F.col("period_end").cast("string"), F.lit("")).alias("end"),
        (-F.col("seq")).alias("place"),
    )
    others = [c for c in records.columns if c not in ("ticker", "fiscal_year")]
    return (
        records.withColumn("period_group", period_group(F.col("period")))
        .groupBy("ticker", "fiscal_year", "period_group")
        .agg(F.max_by(F.struct(*[F.col(c) for c in others]), rank).alias("r"))
        .select("ticker", "fiscal_year", "period_group", "r.*")
    )


def _period_rank(period: Column) -> Column:
    upper = F.upper(F.coalesce(period, F.lit("")))
    ranks = F.when(upper == "FY", 0)
    for i, q in enumerate(QUARTERS, 1):
        ranks = ranks.when(upper == q, i)
    return ranks.otherwise(99)


def _series_columns(previous_revenue: Column, previous_income: Column) -> list[Column]:
    c = F.col
    pct = lambda a, b, name: round2(ratio_percent(c(a), c(b))).alias(name)
    return [
        F.coalesce(F.nullif(c("period"), F.lit("")), F.lit("N/A")).alias("period"),
        period_months(c("period_start"), c("period_end")).alias("period_months"),
        round2(c("revenue")).alias("revenue"),
        round2(c("operating_income")).alias("operating_income"),
        round2(c("net_income")).alias("net_income"),
        pct("net_income", "equity", "roe_percent"),
        pct("net_income", "total_assets", "roa_percent"),
        pct("operating_income", "revenue", "operating_margin_percent"),
        round2(growth_percent(c("revenue"), previous_revenue)).alias("revenue_growth_yoy_percent"),
        round2(growth_percent(c("net_income"), previous_income)).alias("profit_growth_yoy_percent"),
        pct("equity", "total_assets", "equity_ratio_percent"),
        round2(c("operating_cf")).alias("operating_cf"),
        round2(sum_nullable(c("operating_cf"), c("investing_cf"))).alias("free_cash_flow"),
    ]


def annual_series(records: DataFrame) -> DataFrame:
    """Annual metrics with growth against the previous row, also across missing years.

    After `dedup_records` a company has one row per fiscal year, so the window stays small for any
    company.
    """
    annual = records.filter(F.upper(F.coalesce("period", F.lit(""))).isin(*ANNUAL_PERIODS))
    w = Window.partitionBy("ticker").orderBy(
        F.asc_nulls_last("fiscal_year"), _period_rank(F.col("period")), F.coalesce("period_end", F.lit("1000-01-01").cast("date"))
    )
    lagged = annual.select(
        "*", F.lag("revenue").over(w).alias("prev_revenue"), F.lag("net_income").over(w).alias("prev_income"),
        F.row_number().over(w).alias("position"),
    )
    return lagged.select(
        "ticker", "company_name", "fiscal_year", "position", "period_end", "provisional", "statement_type",
        *_series_columns(F.col("prev_revenue"), F.col("prev_income")),
        round2(F.col("total_assets")).alias("total_assets"), round2(F.col("equity")).alias("equity"),
    )


def prior_year_quarter(records: DataFrame) -> DataFrame:
    """Quarterly records with the figures of the same quarter of exactly the fiscal year before.

    A company has one record per quarter and year after `dedup_records`; the row before it in year
    order is the wanted one when its year is one less, so no self join is needed.
    """
    w = Window.partitionBy("ticker", "period_group").orderBy(F.asc_nulls_last("fiscal_year"))
    adjacent = F.lag("fiscal_year").over(w) == F.col("fiscal_year") - 1
    return records.filter(F.upper("period").isin(*QUARTERS)).select(
        "*",
        F.when(adjacent, F.lag("revenue").over(w)).alias("prev_revenue"),
        F.when(adjacent, F.lag("net_income").over(w)).alias("prev_income"),
    )


def quarterly_series(records: DataFrame) -> DataFrame:
    return prior_year_quarter(records).select(
        "ticker", "fiscal_year", "provisional", "statement_type",
        *_series_columns(F.col("prev_revenue"), F.col("prev_income")),
    )


def latest_snapshot(series: DataFrame) -> DataFrame:
    """Last annual row of each company."""
    others = [c for c in series.columns if c != "ticker"]
    return (
        series.groupBy("ticker")
        .agg(F.max_by(F.struct(*[F.col(c) for c in others]), "position").alias("r"))
        .select("ticker", "r.*")
    )


def record_names(records: DataFrame) -> DataFrame:
    """Company name of each company's last record, Unknown when it has none."""
    order = F.struct(
        F.col("fiscal_year").isNull().alias("no_year"), F.col("fiscal_year"),
        _period_rank(F.col("period")).alias("rank"), F.coalesce(F.col("period_end").cast("string"), F.lit("")).alias("end"),
    )
    return records.groupBy("ticker").agg(
        F.coalesce(F.max(F.struct(order.alias("o"), "company_name"))["company_name"], F.lit("Unknown")).alias("company_name"),
        F.count("*").alias("source_count"),
    )

"""Queries: the report's tables and the whole chain from facts to metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import facts as fac
from ledgerloom.catalog import merge as mer
from ledgerloom.catalog import records as rec
from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_fy, s_growth, s_kind, s_quarter, s_r2, s_ratio
from ledgerloom.operators import records as O
from ledgerloom.operators import report as R
from ledgerloom.plans import chains

_OKU = lambda f: f"CASE WHEN {f} IS NULL THEN CASE WHEN absent_{f} THEN '—†' ELSE 'N/A' END ELSE format('{{:,.1f}}', round_even({f} / 1e8 * 1e1, 0) / 1e1 + 0e0) END AS {f}"
_RAW = lambda f, s="": f"CASE WHEN {f} IS NULL THEN CASE WHEN absent_{f} THEN '—†' ELSE 'N/A' END ELSE format('{{:.2f}}', round_even({f} * 1e2, 0) / 1e2 + 0e0) || '{s}' END AS {f}"
_MONEY = ("revenue", "operating_income", "net_income", "free_cash_flow")
_ABS = "CASE WHEN fiscal_year % 4 = 1 THEN 'revenue' WHEN fiscal_year % 4 = 2 THEN 'free_cash_flow' ELSE 'roe_percent' END"
_FY = """CASE WHEN period_months IS NULL OR period_months = 12 THEN coalesce(CAST(fiscal_year AS VARCHAR), 'N/A') ELSE coalesce(CAST(fiscal_year AS VARCHAR), 'N/A') || ' (' ||
  CASE period_months WHEN 3 THEN '四半期' WHEN 6 THEN '半期' WHEN 9 THEN '3Q累計' ELSE period_months || 'M' END || ')' END"""
S_AB = rec.S_ANNUAL + ", ab AS (SELECT *, " + ", ".join(f"coalesce(fiscal_year IS NOT NULL AND {_ABS} = '{f}', false) AS absent_{f}" for f in R.LATEST_FIELDS) + " FROM annual)"


def flagged(t):
    """Annual rows with one field per fiscal year marked as known to be absent."""
    fy = F.col("fiscal_year")
    series = rec.annual(t)
    absences = series.select("ticker", "fiscal_year").filter(fy.isNotNull()).distinct().select(
        "ticker", "fiscal_year",
        F.when(fy % 4 == 1, "revenue").when(fy % 4 == 2, "free_cash_flow").otherwise("roe_percent").alias("field"),
    )
    return R.with_absences(series, absences)


@query("r1_report_tables", rec.DEPS, f"""WITH {S_AB}
SELECT ticker, position, {_FY} || CASE WHEN provisional THEN ' [暫定]' ELSE '' END AS fiscal_year, CASE statement_type WHEN 'standalone' THEN '単体' ELSE '連結' END AS statement,
  {", ".join(_OKU(f) if f in _MONEY else _RAW(f) for f in R.LATEST_FIELDS)} FROM ab""")
def r1(t):
    return R.annual_table(flagged(t), "oku_yen")


_LATEST = " UNION ALL ".join(
    f"SELECT ticker, provisional, {i} AS line, '{f}' AS field, {f} AS text FROM (SELECT ticker, provisional, {_OKU(f) if f in _MONEY else _RAW(f, s)} FROM last)"
    for i, (f, s) in enumerate(R.LATEST_FIELDS.items())
)


@query("r1_report_latest", rec.DEPS, f"WITH {S_AB}, last AS (SELECT * FROM ab QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY position DESC) = 1) {_LATEST}")
def r1_latest(t):
    return R.latest_table(O.latest_snapshot(flagged(t)), "oku_yen")


_QCELL = lambda f: (_OKU(f) if f in _MONEY else _RAW(f)).replace(f"absent_{f}", "false")


@query("r1_report_quarterly", rec.DEPS, f"""WITH {rec.S_DEDUP},
j AS (SELECT c.*, p.revenue AS p_rev, p.net_income AS p_inc FROM ded c LEFT JOIN ded p ON p.ticker = c.ticker AND p.fiscal_year = c.fiscal_year - 1
   AND p.period = c.period WHERE c.period IN ('Q1','Q2','Q3','Q4')),
qs AS (SELECT ticker, fiscal_year, provisional, {rec._SERIES} FROM j)
SELECT ticker, coalesce(CAST(fiscal_year AS VARCHAR), 'N/A') || CASE WHEN provisional THEN ' [暫定]' ELSE '' END AS fiscal_year, period, {", ".join(_QCELL(f) for f in R.QUARTERLY_FIELDS)} FROM qs""")
def r1_quarterly(t):
    return R.quarterly_table(O.quarterly_series(rec.deduped(t)), "oku_yen")


_TXT = lambda x, fmt, m: f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE format('{fmt}', round_even(({x}) * {m}, 0) / {m} + 0e0) END"


@query("r1_report_valuation", rec.VDEPS, f"""WITH {rec.S_FCF}, v AS (SELECT *, CASE WHEN n > 0 THEN {rec._s_pv('base', 'g', '8e-2', '2e-2')} END AS ev FROM grown)
SELECT v.ticker, {_TXT('ev / 1e8', '{:,.1f}', '1e1')} AS enterprise_value, {_TXT('(ev - net_debt) / 1e8', '{:,.1f}', '1e1')} AS equity_value,
  {_TXT('CASE WHEN v.shares > 0 THEN (ev - net_debt) / v.shares END', '{:,.0f}', '1e0')} AS per_share_value FROM v""")
def r1_valuation(t):
    return R.valuation_table(rec.valued(t), rec.multiples(t)).select("ticker", "enterprise_value", "equity_value", "per_share_value")


_FYS = lambda cond: f"list_sort(list_distinct(list(fiscal_year) FILTER (WHERE {cond} AND fiscal_year IS NOT NULL)))"
_JOIN = lambda a: f"array_to_string(list_transform({a}, lambda y: 'FY' || y), ', ')"


@query("a31_statement_type_notes", rec.DEPS, f"""WITH {rec.S_ANNUAL},
y AS (SELECT ticker, coalesce({_FYS("statement_type = 'standalone'")}, []) AS s, coalesce({_FYS("statement_type = 'consolidated'")}, []) AS c FROM annual GROUP BY ticker),
p AS (SELECT ticker, list_sort(list_distinct(list(fiscal_year) FILTER (WHERE fiscal_year IS NOT NULL))) AS p FROM (SELECT ticker, fiscal_year FROM annual WHERE provisional
   UNION ALL SELECT ticker, fiscal_year FROM ded WHERE provisional AND period IN ('Q1','Q2','Q3','Q4')) GROUP BY ticker)
SELECT y.ticker, CASE WHEN len(s) > 0 THEN {_JOIN('s')} || ' は単体（standalone）財務諸表' END AS standalone_note,
  CASE WHEN len(c) > 0 THEN CASE WHEN len(c) > 2 THEN 'FY' || c[1] || '-FY' || c[len(c)] ELSE {_JOIN('c')} END || ' は連結（consolidated）財務諸表' END AS consolidated_note,
  coalesce({_JOIN('p.p')}, '') AS provisional_years, len(s) > 0 AND len(c) > 0 AS type_changed FROM y LEFT JOIN p USING (ticker)""")
def a31(t):
    records = rec.deduped(t)
    return R.statement_type_notes(O.annual_series(records), O.quarterly_series(records))


@query("a32_source_details", ["b_edinet", "b_statements"], f"""WITH {mer.S_TWO}
SELECT ticker, document_id AS key, arg_max(period_end, (fiscal_year, quarter)) AS value, 'edinet' AS source FROM two WHERE document_id IS NOT NULL GROUP BY ticker, document_id
UNION ALL SELECT ticker, CAST(period_end AS VARCHAR), arg_max(jquants_disclosed_date, (fiscal_year, quarter)), 'jquants' FROM two WHERE jquants_disclosed_date IS NOT NULL GROUP BY ticker, period_end""")
def a32(t):
    return R.source_details(mer.two_sources(t))


@query("w2_chain_facts_to_metrics", ["b_facts", "b_contexts", "b_statements", "b_securities"], f"""WITH {fac.S_TOTALS},
pk AS (SELECT t.*, s.fye_month, row_number() OVER (PARTITION BY t.ticker ORDER BY document_id, period_end) AS seq FROM totals t JOIN b_securities s ON s.ticker = t.ticker),
kp AS (SELECT * REPLACE ({s_fy('period_end', 'fye_month')} AS fiscal_year), {s_quarter('period_end', 'fye_month')} AS quarter, {s_kind('period_end', 'period_start', 'fye_month')} AS kind FROM pk WHERE {mer._COUNT} >= 2),
ed AS (SELECT * FROM kp WHERE kind = 'annual' OR quarter <> 'FY' QUALIFY row_number() OVER (PARTITION BY ticker, fiscal_year, quarter
    ORDER BY CASE WHEN quarter = 'FY' THEN 0 ELSE {mer._RICH} END DESC, CASE WHEN quarter = 'FY' THEN -seq ELSE seq END) = 1),
jq AS (SELECT *, {s_fy('period_end', 'fye_month')} AS fiscal_year, {s_quarter('period_end', 'fye_month')} AS quarter FROM b_statements
    QUALIFY row_number() OVER (PARTITION BY ticker, {s_fy('period_end', 'fye_month')}, {s_quarter('period_end', 'fye_month')}
      ORDER BY CASE WHEN {s_quarter('period_end', 'fye_month')} = 'FY' THEN -seq ELSE seq END) = 1),
m AS (SELECT coalesce(e.ticker, j.ticker) AS ticker, coalesce(e.fiscal_year, j.fiscal_year) AS fiscal_year,
   coalesce(CAST(trunc(e.revenue) AS BIGINT), j.revenue)::DOUBLE AS revenue, coalesce(CAST(trunc(e.net_income) AS BIGINT), j.net_income)::DOUBLE AS net_income,
   coalesce(CAST(trunc(e.total_equity) AS BIGINT), j.equity, CAST(trunc(e.net_assets) AS BIGINT), j.net_assets)::DOUBLE AS equity
   FROM ed e FULL OUTER JOIN jq j ON e.ticker = j.ticker AND e.fiscal_year = j.fiscal_year AND e.quarter = j.quarter WHERE coalesce(e.quarter, j.quarter) = 'FY'),
l AS (SELECT *, lag(revenue) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS p FROM m)
SELECT ticker, fiscal_year, revenue, net_income, {s_r2(s_ratio('net_income', 'equity'))} AS roe_percent, {s_r2(s_growth('revenue', 'p'))} AS revenue_growth_yoy_percent FROM l""")
def chain(t):
    """Facts to periods, merge with the statements, and annual metrics: one plan for all companies."""
    # Lists that no entry of the merge has.
    periods = chains.period_table(t.b_facts, t.b_contexts, t.b_securities, ["source_context_ids", "calculated_fields"])
    integrated = chains.integrated_series(periods, t.b_statements.withColumnRenamed("equity", "total_equity"))
    annual, _, _ = chains.metric_tables(integrated)
    return annual.select("ticker", "fiscal_year", "revenue", "net_income", "roe_percent", "revenue_growth_yoy_percent")

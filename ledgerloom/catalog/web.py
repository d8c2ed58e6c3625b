"""Queries: web research rows, envelopes and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.operators import web as O

_PERIOD = r"^([0-9]{4})[.\-/]([0-9]{1,2})"


def _num(x: str) -> str:
    """The notations that occur in the bridged web rows: plain, ▲ sign, 百万円, ---."""
    body = f"regexp_replace(regexp_replace({x}, '^▲', ''), '百万円$', '')"
    return (
        f"(CASE WHEN {x} <> '---' THEN CAST({body} AS DOUBLE) * (CASE WHEN contains({x}, '百万') THEN 1e6 ELSE 1e0 END)"
        f" * (CASE WHEN starts_with({x}, '▲') THEN -1e0 ELSE 1e0 END) END)"
    )


S_ROWS = f"""h0 AS (SELECT ticker, site, seq, v, CASE WHEN site <> 'shikiho' AND regexp_matches(period, '{_PERIOD}')
     THEN last_day(make_date(CAST(left(period, 4) AS INTEGER), CAST(substr(period, 6, 2) AS INTEGER), 1)) END AS period_end, coalesce(contains(period, '予'), false) AS is_forecast,
   {_num('revenue')} AS revenue, {_num('operating_income')} AS operating_income,
   CASE WHEN site <> 'yahoo' THEN {_num('ordinary_income')} END AS ordinary_income, CASE WHEN site <> 'yahoo' THEN {_num('net_income')} END AS net_income,
   CASE WHEN site = 'kabutan' THEN {_num('eps')} END AS eps FROM b_web_rows WHERE collected),
h AS (SELECT *, CAST(year(period_end) AS INTEGER) AS fiscal_year FROM h0 WHERE site <> 'shikiho' OR coalesce(revenue, operating_income, ordinary_income, net_income) IS NOT NULL)"""


@query("a27_harmonize_rows", ["b_web_rows"], f"WITH {S_ROWS} SELECT ticker, site, seq, period_end, is_forecast, fiscal_year, revenue, operating_income, ordinary_income, net_income, eps FROM h")
def a27(t):
    return O.harmonize_rows(t.b_web_rows)


_BEST = ", ".join(
    f"arg_max({n}, (CASE site WHEN 'shikiho' THEN 1 WHEN 'yahoo' THEN 2 ELSE 3 END, seq)) FILTER (WHERE {n} IS NOT NULL) AS {n}" for n in O.PL_FIELDS
)


@query("a26_harmonize_periods", ["b_web_rows"], f"""WITH {S_ROWS},
g AS (SELECT ticker, period_end, fiscal_year, 'web:' || concat_ws('+', max(CASE WHEN site = 'shikiho' THEN site END), max(CASE WHEN site = 'yahoo' THEN site END), max(CASE WHEN site = 'kabutan' THEN site END)) AS source, {_BEST} FROM h GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC NULLS LAST) AS INTEGER) AS position FROM g""")
def a26(t):
    return O.harmonize_periods(O.harmonize_rows(t.b_web_rows)).withColumn("position", F.col("position").cast("int"))


@query("o3_newest_first", ["b_web_rows"], f"""WITH {S_ROWS}, g AS (SELECT DISTINCT ticker, period_end FROM h)
SELECT ticker, period_end, row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC NULLS LAST) AS position FROM g""")
def o3(t):
    return O.harmonize_periods(O.harmonize_rows(t.b_web_rows)).select("ticker", "period_end", F.col("position").cast("bigint").alias("position"))


S_SRC = "src AS (SELECT * FROM b_web_sources QUALIFY row_number() OVER (PARTITION BY ticker, site ORDER BY seq DESC) = 1)"


def sources(t):
    """Newest envelopes with the payload as VARIANT, as a reader delivers it."""
    c = F.col
    payload = F.struct(
        F.struct(
            F.when(c("site") != "shikiho", c("per_text")).alias("per"), F.when(c("site") == "shikiho", c("per_text")).alias("PER_upper"),
            c("pbr_text").alias("pbr"), c("dividend_text").alias("dividend_yield"), c("market_cap_text").alias("market_cap"),
            F.when(c("site") == "yahoo", c("seq").cast("string")).alias("shares_outstanding"),
        ).alias("indicators"),
        F.struct(c("company_text").alias("name")).alias("company_overview"),
        F.struct(c("company_text").alias("company_name")).alias("company_info"),
        F.struct(c("segment").alias("title")).alias("earnings_flash"),
    )
    text = F.replace(F.to_json(payload), F.lit("PER_upper"), F.lit("PER"))
    return O.current_sources(t.b_web_sources.withColumn("data", F.try_parse_json(text)))


@query("p4_source_filter", ["b_web_sources", "b_web_rows"], f"""WITH {S_SRC}, {S_ROWS},
s AS (SELECT t.ticker, x.site FROM (SELECT DISTINCT ticker FROM src) t, (VALUES ('shikiho'), ('yahoo'), ('kabutan')) x(site))
SELECT s.ticker, s.site, CASE WHEN s.site IN ('yahoo', 'kabutan') AND EXISTS (SELECT 1 FROM src WHERE src.ticker = s.ticker AND src.site = s.site AND collected)
  AND EXISTS (SELECT 1 FROM h WHERE h.ticker = s.ticker AND h.site = s.site) THEN 'used' ELSE 'skipped' END AS status FROM s""")
def p4(t):
    return O.source_usage(O.current_sources(t.b_web_sources), O.harmonize_rows(t.b_web_rows), ["yahoo", "kabutan"])


_IND = lambda x: f"CAST(regexp_replace({x}, '[%倍]$', '') AS DOUBLE)"
_CAP = "CAST(regexp_replace(market_cap_text, '億円$', '') AS DOUBLE) * 1e8"
_DIV = f"CASE WHEN dividend_text <> '--' THEN {_IND('dividend_text')} END"


def _pick(x: str) -> str:
    return "coalesce(" + ", ".join(f"max(CASE WHEN site = '{s}' AND collected THEN {x} END)" for s in ("kabutan", "shikiho", "yahoo")) + ")"


@query("a28_indicators", ["b_web_sources", "b_web_rows"], f"""WITH {S_SRC}, {S_ROWS},
e AS (SELECT ticker, {_num('eps')} AS eps FROM
   (SELECT *, CASE WHEN regexp_matches(period, '{_PERIOD}') THEN last_day(make_date(CAST(left(period, 4) AS INTEGER), CAST(substr(period, 6, 2) AS INTEGER), 1)) END AS pe
    FROM b_web_rows WHERE site = 'kabutan' AND collected) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY pe DESC NULLS LAST, seq) = 1)
SELECT i.*, e.eps FROM (SELECT ticker, {_pick('CAST(per_text AS DOUBLE)')} AS per, {_pick(_IND('pbr_text'))} AS pbr, {_pick(_DIV)} AS dividend_yield, {_pick(_CAP)} AS market_cap,
  max(CASE WHEN site = 'yahoo' AND collected THEN seq::DOUBLE END) AS shares_outstanding FROM src GROUP BY ticker) i LEFT JOIN e USING (ticker)""")
def a28(t):
    return O.extract_indicators(sources(t), O.newest_site_eps(t.b_web_rows))


@query("a29_qualitative", ["b_web_sources"], f"""WITH {S_SRC}
SELECT ticker, max(CASE WHEN site = 'shikiho' AND collected THEN '{{"name":"' || company_text || '"}}' END) AS company_overview, NULL::VARCHAR AS consensus, NULL::VARCHAR AS shareholders,
 max(CASE WHEN site = 'kabutan' AND collected THEN '{{"title":"' || segment || '"}}' END) AS earnings_flash, NULL::VARCHAR AS news, NULL::VARCHAR AS ir_links,
 max(CASE WHEN site = 'homepage' AND collected THEN '{{"company_name":"' || company_text || '"}}' END) AS company_info FROM src GROUP BY ticker""")
def a29(t):
    return O.extract_qualitative(sources(t))


_OLD = "SELECT * FROM b_web_sources WHERE seq % 2 = 1 QUALIFY row_number() OVER (PARTITION BY ticker, site ORDER BY seq DESC) = 1"
_NEW = "SELECT * FROM b_web_sources WHERE seq % 2 = 0 QUALIFY row_number() OVER (PARTITION BY ticker, site ORDER BY seq DESC) = 1"
S_UPS = f"""o AS ({_OLD}), n AS ({_NEW}),
ups AS (SELECT coalesce(o.ticker, n.ticker) AS ticker, coalesce(o.site, n.site) AS site, CASE WHEN n.ticker IS NOT NULL THEN n.url ELSE o.url END AS url,
  CASE WHEN n.ticker IS NOT NULL THEN n.collected ELSE o.collected END AS collected, CASE WHEN n.ticker IS NOT NULL THEN n.error ELSE o.error END AS error
  FROM o FULL OUTER JOIN (SELECT * FROM n WHERE site IN ('yahoo', 'homepage')) n ON o.ticker = n.ticker AND o.site = n.site)"""


def upserted(t):
    cols = ["ticker", "site", "url", "collected", "error"]
    half = lambda r: O.current_sources(t.b_web_sources.filter(F.col("seq") % 2 == r)).select(*cols)
    return O.research_upsert(half(1), half(0), ["yahoo", "homepage"])


@query("j15_research_upsert", ["b_web_sources"], f"WITH {S_UPS} SELECT * FROM ups")
def j15(t):
    return upserted(t)


@query("a21_research_counts", ["b_web_sources"], f"""WITH {S_UPS} SELECT ticker, count(*) AS source_count, count(*) FILTER (WHERE collected) AS success_count, count(error) AS error_count FROM ups GROUP BY ticker""")
def a21_research(t):
    return O.research_counts(upserted(t))


@query("j16_source_fallback", ["b_web_sources"], f"""WITH {S_SRC},
x AS (SELECT s.*, y.url AS b_url, y.per_text AS b_per, NOT s.collected AND y.ticker IS NOT NULL AS reuse FROM src s
  LEFT JOIN src y ON y.ticker = s.ticker AND y.site = 'yahoo' AND y.collected WHERE s.site = 'shikiho')
SELECT ticker, site, CASE WHEN reuse THEN b_url ELSE url END AS url, collected OR reuse AS collected, CASE WHEN reuse THEN b_per ELSE per_text END AS per_text,
  CASE WHEN NOT reuse THEN error END AS error, CASE WHEN reuse THEN 'yahoo' END AS fallback_source, CASE WHEN reuse THEN error END AS fallback_reason FROM x""")
def j16(t):
    return O.source_fallback(O.current_sources(t.b_web_sources))


@query("j13_web_company_name", ["b_web_sources", "b_securities"], f"""WITH {S_SRC},
n AS (SELECT ticker, max(CASE WHEN site = 'shikiho' AND collected THEN company_text END) AS a, max(CASE WHEN site = 'homepage' AND collected THEN company_text END) AS b FROM src GROUP BY ticker)
SELECT s.ticker, coalesce(CASE WHEN s.suppkey % 3 = 0 THEN s.company_name END, n.a, n.b) AS company_name FROM b_securities s LEFT JOIN n ON n.ticker = s.ticker""")
def j13_web(t):
    research = t.b_securities.select("ticker", F.when(F.col("suppkey") % 3 == 0, F.col("company_name")).otherwise("").alias("company_name"))
    return O.web_company_name(research, sources(t))

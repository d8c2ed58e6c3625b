"""Queries: selection of entries and the merge of the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_fy, s_kind, s_quarter
from ledgerloom.operators import merge as O
from ledgerloom.rules.concepts import BS_FIELDS, PL_FIELDS

_COUNT = " + ".join(f"({f} IS NOT NULL)::INT" for f in BS_FIELDS + PL_FIELDS)
_RICH = " + ".join(f"({f} IS NOT NULL)::INT" for f in O.RICHNESS_FIELDS)

S_KEYS = f"""keyed AS (SELECT *, operating_cf + investing_cf AS free_cash_flow, {s_fy('period_end', 'fye_month')} AS fiscal_year,
    {s_quarter('period_end', 'fye_month')} AS quarter, {s_kind('period_end', 'period_start', 'fye_month')} AS kind FROM b_edinet WHERE {_COUNT} >= 2),
ed AS (SELECT * FROM keyed WHERE kind = 'annual' OR quarter <> 'FY' QUALIFY row_number() OVER (PARTITION BY ticker, fiscal_year, quarter
    ORDER BY CASE WHEN quarter = 'FY' THEN 0 ELSE {_RICH} END DESC, CASE WHEN quarter = 'FY' THEN -seq ELSE seq END) = 1),
jq AS (SELECT *, {s_fy('period_end', 'fye_month')} AS fiscal_year, {s_quarter('period_end', 'fye_month')} AS quarter FROM b_statements
    QUALIFY row_number() OVER (PARTITION BY ticker, {s_fy('period_end', 'fye_month')}, {s_quarter('period_end', 'fye_month')}
      ORDER BY CASE WHEN {s_quarter('period_end', 'fye_month')} = 'FY' THEN -seq ELSE seq END) = 1)"""

S_WEB = f"""wraw AS (SELECT ticker, fye_month, seq, CASE WHEN seq % 11 = 4 THEN NULL ELSE period_end END AS period_end,
    CASE WHEN seq % 3 = 0 THEN NULL ELSE CAST(year(period_end) AS INTEGER) END AS fy0,
    CASE WHEN suppkey % 2 = 0 THEN 'web:kabutan+yahoo' ELSE 'web:yahoo' END AS web_source,
    revenue, gross_profit, operating_income, ordinary_income, net_income, CAST(net_income % 997 AS DOUBLE) AS eps
    FROM b_records WHERE source = 'web' AND month(period_end) = fye_month),
web AS (SELECT * FROM (SELECT *, coalesce(fy0, {s_fy('period_end', 'fye_month')}) AS fiscal_year, 'FY' AS quarter FROM wraw WHERE period_end IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY ticker, fiscal_year ORDER BY seq) = 1)"""


def filings(t):
    return O.filing_entries(
        t.b_edinet.withColumn("free_cash_flow", F.col("operating_cf") + F.col("investing_cf"))
    )


def statements(t):
    return O.statement_entries(t.b_statements.withColumnRenamed("equity", "total_equity"))


def web_rows(t):
    c = F.col
    return t.b_records.filter((c("source") == "web") & (F.month("period_end") == c("fye_month"))).select(
        "ticker", "fye_month", "seq",
        F.when(c("seq") % 11 != 4, c("period_end")).alias("period_end"),
        F.when(c("seq") % 3 != 0, F.year("period_end")).alias("fiscal_year"),
        F.when(c("suppkey") % 2 == 0, "web:kabutan+yahoo").otherwise("web:yahoo").alias("web_source"),
        *O.WEB_FIELDS, (c("net_income") % 997).cast("double").alias("eps"),
    )


def two_sources(t):
    return O.merge_entries(filings(t), statements(t))


def three_sources(t):
    return O.merge_entries(filings(t), statements(t), O.web_entries(web_rows(t)))


@query("p2_min_facts", ["b_edinet"], f"""
SELECT ticker, seq, CAST({_COUNT} AS INTEGER) AS known FROM b_edinet WHERE {_COUNT} >= 10""")
def p2(t):
    from ledgerloom.functions.numbers import non_null_count

    rows = O.enough_facts(t.b_edinet, 10)
    return rows.select("ticker", "seq", non_null_count(*[F.col(f) for f in BS_FIELDS + PL_FIELDS]).alias("known"))


@query("a10_extract_annual_quarterly", ["b_edinet", "b_statements"], f"""WITH {S_KEYS}
SELECT 'edinet' AS source, ticker, fiscal_year, quarter, period_end, seq_id, total_assets, revenue FROM
  (SELECT *, document_id AS seq_id FROM ed)
UNION ALL SELECT 'jquants', ticker, fiscal_year, quarter, period_end, CAST(disclosed_date AS VARCHAR), total_assets, revenue FROM jq""")
def a10(t):
    picked = O.pick_entries(filings(t).unionByName(statements(t)))
    return picked.select(
        "source", *O.KEYS, "period_end", F.coalesce("document_id", F.col("disclosed_date").cast("string")).alias("seq_id"),
        "total_assets", "revenue",
    )


@query("p7_web_row_guard", ["b_records"], f"""WITH {S_WEB}
SELECT ticker, fiscal_year, period_end, web_source, revenue, eps FROM web""")
def p7(t):
    return O.pick_entries(O.web_entries(web_rows(t))).select("ticker", "fiscal_year", "period_end", "web_source", "revenue", "eps")


_JQ_NAME = {f: ("j.equity" if f == "total_equity" else f"j.{f}") for f in O.STATEMENT_FIELDS}
_TWO = ", ".join(
    f"coalesce(e.{f}, {_JQ_NAME[f]}) AS {f}" if f in O.STATEMENT_FIELDS else f"e.{f} AS {f}" for f in O.MERGE_FIELDS
)
S_TWO = S_KEYS + f""",
two AS (SELECT coalesce(e.ticker, j.ticker) AS ticker, coalesce(e.fiscal_year, j.fiscal_year) AS fiscal_year, coalesce(e.quarter, j.quarter) AS quarter,
   CASE WHEN e.ticker IS NOT NULL THEN e.period_end ELSE j.period_end END AS period_end,
   CASE WHEN e.ticker IS NOT NULL THEN e.period_start ELSE j.period_start END AS period_start, e.statement_type, e.document_id,
   CASE WHEN e.ticker IS NULL THEN 'jquants' WHEN j.ticker IS NULL THEN 'edinet' ELSE 'both' END AS source,
   CASE WHEN e.ticker IS NOT NULL THEN j.disclosed_date END AS jquants_disclosed_date, {_TWO}
   FROM ed e FULL OUTER JOIN jq j ON e.ticker = j.ticker AND e.fiscal_year = j.fiscal_year AND e.quarter = j.quarter)"""


@query("j5_merge_two_sources", ["b_edinet", "b_statements"], f"WITH {S_TWO} SELECT * FROM two")
def j5(t):
    return two_sources(t)


def _three(f: str) -> str:
    parts = [f"e.{f}"] + ([f"w.{f}"] if f in O.WEB_FIELDS else []) + ([_JQ_NAME[f]] if f in O.STATEMENT_FIELDS else [])
    return f"coalesce({', '.join(parts)}, NULL) AS {f}"


S_THREE = S_KEYS + ", " + S_WEB + f""",
keys AS (SELECT ticker, fiscal_year, quarter FROM ed UNION SELECT ticker, fiscal_year, quarter FROM web UNION SELECT ticker, fiscal_year, quarter FROM jq),
three AS (SELECT k.ticker, k.fiscal_year, k.quarter,
   CASE WHEN e.ticker IS NOT NULL THEN e.period_end WHEN w.ticker IS NOT NULL THEN w.period_end ELSE j.period_end END AS period_end,
   CASE WHEN e.ticker IS NOT NULL THEN e.period_start WHEN w.ticker IS NOT NULL THEN NULL ELSE j.period_start END AS period_start,
   e.statement_type, e.document_id,
   CASE WHEN w.ticker IS NOT NULL THEN concat_ws('+', CASE WHEN e.ticker IS NOT NULL THEN 'edinet' END, 'web', CASE WHEN j.ticker IS NOT NULL THEN 'jquants' END)
        WHEN e.ticker IS NOT NULL AND j.ticker IS NOT NULL THEN 'both' WHEN e.ticker IS NOT NULL THEN 'edinet' ELSE 'jquants' END AS source,
   CASE WHEN e.ticker IS NOT NULL OR w.ticker IS NOT NULL THEN j.disclosed_date END AS jquants_disclosed_date, w.web_source, w.eps,
   {", ".join(_three(f) for f in O.MERGE_FIELDS)}
   FROM keys k LEFT JOIN ed e USING (ticker, fiscal_year, quarter) LEFT JOIN web w USING (ticker, fiscal_year, quarter) LEFT JOIN jq j USING (ticker, fiscal_year, quarter))"""
THREE_DEPS = ["b_edinet", "b_statements", "b_records"]


@query("j6_merge_three_sources", THREE_DEPS, f"WITH {S_THREE} SELECT * FROM three")
def j6(t):
    return three_sources(t)


@query("a11_coverage_summary", THREE_DEPS, f"""WITH {S_THREE},
g AS (SELECT ticker, fiscal_year, max(CASE WHEN quarter = 'FY' THEN source END) AS annual,
    list_sort(list_distinct(list(quarter) FILTER (WHERE quarter <> 'FY'))) AS q, list_sort(list_distinct(list(source))) AS s FROM three GROUP BY ALL)
SELECT ticker, fiscal_year, annual, coalesce(array_to_string(q, ','), '') AS quarters, array_to_string(s, ',') AS sources,
   concat_ws(', ', 'annual=' || annual, CASE WHEN len(q) > 0 THEN 'quarters=[''' || array_to_string(q, ''', ''') || ''']' END,
   'sources=[''' || array_to_string(s, ''', ''') || ''']') AS rule FROM g""")
def a11(t):
    return O.coverage_summary(three_sources(t)).select(
        "ticker", "fiscal_year", "annual", F.array_join("quarters", ",").alias("quarters"),
        F.array_join("sources", ",").alias("sources"), "rule",
    )


@query("a12_coverage_matrix", THREE_DEPS, f"""WITH {S_THREE}
SELECT ticker, period_end, fiscal_year, quarter, source, document_id,
  CASE WHEN source = 'jquants' THEN 'consolidated' ELSE statement_type END AS statement_type FROM three""")
def a12(t):
    return O.coverage_matrix(three_sources(t))


_K = "ticker, fiscal_year, quarter"


@query("u1_key_union", THREE_DEPS, f"WITH {S_KEYS}, {S_WEB} SELECT {_K} FROM ed UNION SELECT {_K} FROM web UNION SELECT {_K} FROM jq")
def u1(t):
    return O.source_keys(filings(t), O.web_entries(web_rows(t)), statements(t))


@query("u2_key_intersect", ["b_edinet", "b_statements"], "SELECT ticker, period_end FROM b_edinet INTERSECT SELECT ticker, period_end FROM b_statements")
def u2(t):
    keys = ["ticker", "period_end"]
    return t.b_edinet.select(*keys).intersect(t.b_statements.select(*keys))


@query("u3_key_except", ["b_edinet", "b_statements"], "SELECT ticker, period_end FROM b_statements EXCEPT SELECT ticker, period_end FROM b_edinet")
def u3(t):
    keys = ["ticker", "period_end"]
    return t.b_statements.select(*keys).distinct().join(t.b_edinet.select(*keys).distinct(), keys, "left_anti")


@query("u4_append", ["b_edinet", "b_statements"], f"""WITH {S_KEYS}
SELECT ticker, fiscal_year, quarter, document_id, NULL::DATE AS disclosed_date FROM ed
UNION ALL SELECT ticker, fiscal_year, quarter, NULL, disclosed_date FROM jq""")
def u4(t):
    picked = lambda candidates, column: O.pick_entries(candidates).select(*O.KEYS, column)
    return picked(filings(t), "document_id").unionByName(
        picked(statements(t), "disclosed_date"), allowMissingColumns=True
    )

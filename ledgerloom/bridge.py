"""Statement-shaped tables derived from the driver's TPC-H-like tables.

Each bridged table is one SELECT in the dialect shared by Spark SQL and DuckDB, so the same rows
feed the Spark operators and the check SQL. Decimal fractions are written in e-notation because
both engines read `5e-1` as a double and `0.5` as a decimal. Ship dates are moved 24 years ahead,
so that fiscal years fall on both sides of the 2024 change of the half-year rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.rules.lexicons import RISK_KEYWORDS, SEVERITY_HIGH, SEVERITY_LOW

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

BRIDGE_SQL: dict[str, str] = {}

# Security master: one listed company per supplier.
BRIDGE_SQL["b_securities"] = """
SELECT s.s_suppkey AS suppkey,
       cast(1000 + s.s_suppkey AS string) AS ticker,
       cast(1000 + s.s_suppkey AS string) || '0' AS sec_code,
       'E' || cast(10000 + s.s_suppkey AS string) AS edinet_code,
       s.s_name AS company_name,
       n.n_name AS industry,
       cast(3 * (1 + s.s_suppkey % 4) AS int) AS fye_month,
       CASE s.s_suppkey % 5
            WHEN 0 THEN cast(3 * (1 + s.s_suppkey % 4) AS string) || '月31日'
            WHEN 1 THEN cast(3 * (1 + s.s_suppkey % 4) AS string) || '月'
            WHEN 2 THEN '0' || cast(3 * (1 + s.s_suppkey % 4) AS string) || '/30'
            WHEN 3 THEN 'unknown' END AS fye_text,
       CASE WHEN s.s_suppkey % 11 = 7 THEN '非上場' WHEN s.s_suppkey % 13 = 5 THEN '' ELSE '上場' END
         AS listing,
       CASE WHEN s.s_suppkey % 6 = 0 THEN NULL
            ELSE 'http://www.co' || cast(s.s_suppkey AS string) || '.example.com:8080/ir/' END AS hp,
       cast(floor(s.s_acctbal * 100 + 5e-1) AS bigint) AS balance
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""

# Money per company, source, calendar quarter and document version, in integer cents.
BRIDGE_SQL["b_quarters"] = """
SELECT l_suppkey AS suppkey,
       CASE l_returnflag WHEN 'A' THEN 'edinet' WHEN 'R' THEN 'web' ELSE 'jquants' END AS source,
       cast(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS int) AS src_no,
       cast(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS int) AS v,
       cast(year(l_shipdate) + 24 AS int) AS y,
       cast(quarter(l_shipdate) AS int) AS q,
       cast(sum(cast(floor(l_extendedprice * 100 + 5e-1) AS bigint)) AS bigint) AS sales,
       cast(sum(cast(floor(l_extendedprice * l_discount * 100 + 5e-1) AS bigint)) AS bigint) AS disc,
       cast(sum(cast(floor(l_extendedprice * l_tax * 100 + 5e-1) AS bigint)) AS bigint) AS tax,
       cast(count(*) AS bigint) AS n
FROM {lineitem}
GROUP BY l_suppkey, l_returnflag, l_linestatus, year(l_shipdate), quarter(l_shipdate)
"""

# Parsed statement periods; version 1 rows are the prior-year column of the same document.
BRIDGE_SQL["b_records"] = """
SELECT s.ticker, s.company_name, s.fye_month, s.industry, r.source, r.suppkey, r.v,
       'S' || s.ticker || '-' || cast(r.y AS string) || 'q' || cast(r.q AS string) AS document_id,
       cast((r.y * 4 + r.q) * 2 + r.v AS bigint) AS seq,
       CASE WHEN (r.suppkey + r.q + r.v) % 9 = 4 THEN NULL
            WHEN 3 * r.q = s.fye_month THEN make_date(CASE WHEN r.q = 4 THEN r.y - r.v ELSE r.y - r.v - 1 END,
                                                      CASE WHEN r.q = 4 THEN 1 ELSE 3 * r.q + 1 END, 1)
            WHEN (3 * r.q - s.fye_month + 12) % 12 = 6 AND r.suppkey % 2 = 0 THEN
                 make_date(CASE WHEN r.q = 1 THEN r.y - r.v - 1 ELSE r.y - r.v END,
                           CASE WHEN r.q = 1 THEN 10 ELSE 3 * r.q - 5 END, 1)
            ELSE make_date(r.y - r.v, 3 * r.q - 2, 1) END AS period_start,
       last_day(make_date(r.y - r.v, 3 * r.q, 1)) AS period_end,
       CASE (r.suppkey + r.y + r.q + r.v) % 4 WHEN 1 THEN 'duration' WHEN 2 THEN 'instant'
            ELSE 'mixed' END AS period_type,
       CASE WHEN r.suppkey % 7 = 3 THEN 'standalone' ELSE 'consolidated' END AS statement_type,
       (r.suppkey + r.y + r.q) % 8 = 1 AS provisional,
       last_day(make_date(r.y, 3 * r.q, 1)) AS disclosed_date,
       CASE WHEN (r.suppkey + 3 * r.q + r.v + r.src_no) % 10 <> 0 THEN r.sales * 3 END AS total_assets,
       CASE WHEN (r.suppkey + r.q) % 8 <> 0 THEN r.sales END AS current_assets,
       CASE WHEN (r.suppkey + r.y) % 9 <> 0 THEN r.sales * 2 - r.n END AS noncurrent_assets,
       CASE WHEN (r.suppkey + r.y + r.q) % 4 <> 0 THEN r.sales + r.n * 7 END AS total_liabilities,
       CASE WHEN (r.suppkey + r.y) % 3 <> 0 THEN r.disc * 4 END AS current_liabilities,
       CASE WHEN (r.suppkey + r.q + r.src_no) % 3 <> 0 THEN r.tax * 5 END AS noncurrent_liabilities,
       CASE WHEN (r.suppkey + r.y + r.v) % 11 <> 0 THEN r.sales * 2 - r.n * 9 END AS total_equity,
       CASE WHEN (r.suppkey + r.src_no) % 5 <> 0 THEN r.sales * 2 - r.n * 7 END AS net_assets,
       CASE WHEN (r.suppkey + 5 * r.q + r.v + r.src_no) % 12 <> 0 THEN r.sales END AS revenue,
       CASE WHEN (r.y + r.q + r.src_no) % 6 <> 1 THEN r.sales - r.tax END AS gross_profit,
       CASE WHEN (r.suppkey + r.y + r.src_no) % 10 <> 3 THEN r.disc - r.n * 20000 END AS operating_income,
       CASE WHEN (r.suppkey + r.y + r.q) % 7 <> 5 THEN r.disc - r.n * 21000 END AS ordinary_income,
       CASE WHEN (r.suppkey + r.y + r.v) % 13 <> 2 THEN r.tax - r.n * 60000 END AS net_income,
       CASE WHEN (r.suppkey + r.q + r.v) % 6 <> 2 THEN r.disc + r.n * 1000 END AS operating_cf,
       CASE WHEN (r.suppkey + r.y) % 5 <> 1 THEN 0 - r.tax END AS investing_cf,
       CASE WHEN (r.y + r.q) % 4 <> 3 THEN r.n * 3000 - r.disc END AS financing_cf
FROM {b_quarters} r JOIN {b_securities} s ON r.suppkey = s.suppkey
"""

# Filing rows used by the merge: some quarters are missing on purpose.
BRIDGE_SQL["b_edinet"] = """
SELECT * FROM {b_records} WHERE source = 'edinet'
"""

# Earnings statements: mostly the filing figures with small or large differences, plus own periods.
BRIDGE_SQL["b_statements"] = """
SELECT ticker, company_name, fye_month, suppkey,
       seq * 2 + CASE WHEN source = 'jquants' THEN 1 ELSE 0 END AS seq,
       CASE WHEN suppkey % 5 = 4 THEN NULL ELSE period_start END AS period_start,
       period_end, disclosed_date,
       CASE WHEN month(period_end) = fye_month THEN 'FY'
            WHEN (month(period_end) - fye_month + 12) % 12 = 3 THEN '1Q'
            WHEN (month(period_end) - fye_month + 12) % 12 = 6 THEN '2Q' ELSE '3Q' END AS type_of_current_period,
       CASE WHEN suppkey % 3 = 0 THEN 'EarnForecastRevision'
            ELSE 'FYFinancialStatements_Consolidated_JP' END AS type_of_document,
       CASE WHEN (suppkey + seq) % 5 = 0 THEN NULL
            WHEN (suppkey + seq) % 5 = 1 THEN revenue + cast(floor(revenue * 2e-2) AS bigint)
            WHEN (suppkey + seq) % 5 = 2 THEN revenue + cast(floor(revenue * 5e-5) AS bigint)
            ELSE revenue END AS revenue,
       CASE WHEN (suppkey + seq) % 6 IN (0, 5) THEN NULL ELSE operating_income END AS operating_income,
       CASE WHEN (suppkey + seq) % 5 = 0 THEN NULL ELSE ordinary_income END AS ordinary_income,
       CASE WHEN (suppkey + seq) % 5 = 0 THEN NULL
            WHEN (suppkey + seq) % 7 = 1 THEN 0 ELSE net_income END AS net_income,
       CASE WHEN (suppkey + seq) % 5 = 0 THEN NULL ELSE total_assets END AS total_assets,
       CASE WHEN (suppkey + seq) % 5 = 0 THEN NULL ELSE total_equity END AS equity,
       net_assets, operating_cf
FROM {b_records}
WHERE source IN ('edinet', 'jquants')
"""

# Statement facts: one fact per line item, so the fact table is as long as lineitem.
BRIDGE_SQL["b_facts"] = """
SELECT cast(1000 + l_suppkey AS string) AS ticker,
       'S' || cast(1000 + l_suppkey AS string) || '-' || cast(year(l_shipdate) + 24 AS string)
         || 'q' || cast(quarter(l_shipdate) AS string) AS document_id,
       (l_orderkey * 8 + l_linenumber) * 1000003 + l_partkey AS seq,
       split_part('jppfs_cor:TotalAssets|Assets-Total|Current_Assets|FixedAssets|Liabilities|CurrentLiabilities|'
         || 'NoncurrentLiabilities|ShareholdersEquity|NetAssets|NetSales|Operating Revenue|GrossProfit|OperatingIncome|'
         || 'OrdinaryIncomeLoss|ProfitLoss|NetCashProvidedByUsedInOperatingActivities|'
         || 'NetCashProvidedByUsedInInvestmentActivities|NetCashProvidedByUsedInFinancingActivities|'
         || 'FilerNameInJapaneseDEI|NumberOfEmployees', '|', cast(l_partkey % 20 + 1 AS int)) AS concept,
       split_part('CurrentYearDuration|CurrentYearInstant|Prior1YearDuration|CurrentYearDuration_NonConsolidatedMember|'
         || 'CurrentQuarterDuration|CurrentYearInstant_ConsolidatedMember|Prior1YearInstant|FilingDateInstant', '|',
         cast(l_orderkey % 8 + 1 AS int)) AS context_id,
       CASE WHEN l_partkey % 20 = 18 THEN 'Supplier ' || cast(l_suppkey AS string)
            WHEN l_quantity = 1 THEN '－' WHEN l_quantity = 2 THEN '-' WHEN l_quantity = 3 THEN 'n/a'
            WHEN l_quantity = 4 THEN ''
            WHEN l_quantity < 10 THEN cast(cast(floor(l_extendedprice) AS bigint) AS string) || '.5'
            WHEN l_quantity < 25 AND l_extendedprice >= 1000 THEN
                 cast(cast(floor(l_extendedprice / 1000) AS bigint) AS string) || ','
                 || lpad(cast(cast(floor(l_extendedprice) AS bigint) % 1000 AS string), 3, '0')
            ELSE ' ' || cast(cast(floor(l_extendedprice * 100 + 5e-1) AS bigint) AS string) || ' ' END AS text,
       CASE WHEN l_tax > 6e-2 THEN '-' END AS sign
FROM {lineitem}
"""

BRIDGE_SQL["b_contexts"] = """
SELECT 'S' || cast(1000 + suppkey AS string) || '-' || cast(y AS string) || 'q' || cast(q AS string)
         AS document_id,
       context_id,
       CASE WHEN context_id LIKE '%Instant%' THEN 'instant' ELSE 'duration' END AS period_type,
       CASE WHEN context_id LIKE '%Instant%' THEN NULL
            WHEN context_id = 'CurrentQuarterDuration' THEN make_date(y, 3 * q - 2, 1)
            ELSE make_date(CASE WHEN context_id LIKE 'Prior%' THEN y - 1 ELSE y END
                           - CASE WHEN q = 4 THEN 0 ELSE 1 END,
                           CASE WHEN q = 4 THEN 1 ELSE 3 * q + 1 END, 1) END AS start_date,
       last_day(make_date(CASE WHEN context_id LIKE 'Prior%' THEN y - 1 ELSE y END, 3 * q, 1)) AS period_end
FROM (SELECT DISTINCT l_suppkey AS suppkey, cast(year(l_shipdate) + 24 AS int) AS y,
             cast(quarter(l_shipdate) AS int) AS q,
             split_part('CurrentYearDuration|CurrentYearInstant|Prior1YearDuration|CurrentYearDuration_NonConsolidatedMember|'
               || 'CurrentQuarterDuration|CurrentYearInstant_ConsolidatedMember|Prior1YearInstant|Prior1YearInstant', '|',
               cast(l_orderkey % 8 + 1 AS int)) AS context_id
      FROM {lineitem}) d
"""

# Daily filing index.
BRIDGE_SQL["b_filings"] = """
SELECT 'S' || cast(o_orderkey AS string) AS "docID",
       'E' || cast(cast(floor(10000 + o_custkey / 15) AS bigint) AS string) AS "edinetCode",
       cast(cast(floor(1000 + o_custkey / 15) AS bigint) AS string) || '0' AS "secCode",
       CASE o_orderkey % 4 WHEN 0 THEN '120' WHEN 1 THEN '140' WHEN 2 THEN '160' END AS "docTypeCode",
       CASE o_orderstatus WHEN 'O' THEN '030000' WHEN 'F' THEN '043000' ELSE '050000' END AS "formCode",
       CASE o_orderpriority WHEN '1-URGENT' THEN '有価証券報告書－第' || cast(o_orderkey % 90 AS string) || '期'
            WHEN '2-HIGH' THEN '四半期報告書－第3四半期' WHEN '3-MEDIUM' THEN '半期報告書'
            WHEN '4-NOT SPECIFIED' THEN '臨時報告書' END AS "docDescription",
       CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE '1' END AS "xbrlFlag",
       CASE WHEN o_orderkey % 6 = 0 THEN ' ' ELSE 'Filer ' || cast(o_custkey % 7 AS string) END AS "filerName",
       last_day(make_date(cast(year(o_orderdate) + 24 AS int), cast(3 * quarter(o_orderdate) AS int), 1)) AS period_end,
       cast(o_orderdate AS date) AS list_date,
       o_orderkey AS seq
FROM {orders}
"""

# Download manifests; several rows per document, as collection runs repeat.
BRIDGE_SQL["b_manifests"] = """
SELECT cast(cast(floor(1000 + o_custkey / 15) AS bigint) AS string) AS ticker,
       'manifest_' || cast(o_orderkey % 4 AS string) || '.json' AS source_file,
       cast(cast(o_orderdate AS date) AS string) || 'T0' || cast(o_orderkey % 3 AS string) || ':00:00+00:00' AS fetched_at,
       'S' || cast(cast(floor(1000 + o_custkey / 15) AS bigint) AS string) || '-'
         || cast(year(o_orderdate) + 24 AS string) || 'q' || cast(quarter(o_orderdate) AS string) AS doc_id,
       CASE o_orderstatus WHEN 'O' THEN 'downloaded' WHEN 'F' THEN 'skipped_existing' ELSE 'failed' END AS status,
       CASE WHEN o_orderkey % 17 = 3 THEN NULL
            ELSE cast(last_day(make_date(cast(year(o_orderdate) + 24 AS int), cast(3 * quarter(o_orderdate) AS int), 1))
                      AS string) END AS period_end,
       cast(o_orderdate AS date) AS list_date,
       o_orderkey AS seq
FROM {orders}
"""

# Raw earnings statements, every figure a string.
BRIDGE_SQL["b_raw_statements"] = """
SELECT cast(cast(floor(1000 + o_custkey / 15) AS bigint) AS string) AS ticker,
       o_orderkey AS seq,
       cast(cast(o_orderdate AS date) AS string) AS "DisclosedDate",
       CASE o_orderkey % 4 WHEN 0 THEN 'FY' WHEN 1 THEN '1Q' WHEN 2 THEN '2Q' ELSE '3Q' END AS "TypeOfCurrentPeriod",
       cast(last_day(make_date(cast(year(o_orderdate) + 24 AS int), cast(3 * (1 + floor(o_custkey / 15) % 4) AS int), 1)) AS string)
         AS "CurrentFiscalYearEndDate",
       CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN 'N/A' WHEN 3 THEN '1000.9'
            WHEN 4 THEN cast(cast(floor(o_totalprice / 1000) AS bigint) AS string) || ','
                 || lpad(cast(cast(floor(o_totalprice) AS bigint) % 1000 AS string), 3, '0')
            WHEN 5 THEN ' ' || cast(cast(floor(o_totalprice) AS bigint) AS string) || ' '
            WHEN 6 THEN '-' || cast(cast(floor(o_totalprice) AS bigint) AS string)
            WHEN 7 THEN NULL ELSE cast(cast(floor(o_totalprice) AS bigint) AS string) END AS "NetSales",
       CASE o_orderkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'abc'
            ELSE cast(cast(floor(o_totalprice / 10) AS bigint) AS string) END AS "OperatingProfit",
       CASE o_orderkey % 7 WHEN 0 THEN 'NaN' WHEN 1 THEN 'inf' WHEN 2 THEN '--' WHEN 3 THEN '1,234.5'
            WHEN 4 THEN '12d' ELSE cast(o_orderkey % 300 AS string) || '.25' END AS "EarningsPerShare",
       CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'x1' ELSE cast(o_orderkey % 1000 + 100 AS string) END AS issued,
       CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'bad' WHEN 2 THEN '5000' ELSE cast(o_orderkey % 50 AS string) END AS treasury
FROM {orders}
"""

# Number, date and code strings in the notations the parsers meet.
BRIDGE_SQL["b_strings"] = """
SELECT p_partkey AS id, p_size AS n,
       CASE p_partkey % 21
            WHEN 0 THEN cast(p_size AS string) || ',234.56'
            WHEN 1 THEN cast(p_size AS string) || '兆2,345億'
            WHEN 2 THEN cast(p_size AS string) || ',234億5,678万円'
            WHEN 3 THEN cast(p_size AS string) || '万'
            WHEN 4 THEN '△' || cast(p_size AS string) || ',234'
            WHEN 5 THEN '▲' || cast(p_size AS string) || '00'
            WHEN 6 THEN cast(p_size AS string) || '.58倍'
            WHEN 7 THEN '2.' || cast(p_size AS string) || '%'
            WHEN 8 THEN cast(p_size AS string) || ',720円'
            WHEN 9 THEN '---'
            WHEN 10 THEN ''
            WHEN 11 THEN NULL
            WHEN 12 THEN cast(p_size AS string) || ',234百万円'
            WHEN 13 THEN '-' || cast(p_size AS string) || ',000'
            WHEN 14 THEN '−' || cast(p_size AS string) || '株'
            WHEN 15 THEN 'N/A'
            WHEN 16 THEN p_type
            WHEN 17 THEN cast(p_size AS string) || 'x億'
            WHEN 18 THEN '－'
            WHEN 19 THEN '　' || cast(p_size AS string) || ' 億 '
            ELSE cast(p_retailprice AS string) END AS num_text,
       CASE p_partkey % 15
            WHEN 0 THEN cast(p_size AS string) || ',234'
            WHEN 1 THEN '(' || cast(p_size AS string) || ',567)'
            WHEN 2 THEN '△ ' || cast(p_size AS string) || '89'
            WHEN 3 THEN '－' || cast(p_size AS string)
            WHEN 4 THEN '※１ ' || cast(p_size AS string) || ',000'
            WHEN 5 THEN '―'
            WHEN 6 THEN ''
            WHEN 7 THEN NULL
            WHEN 8 THEN '（' || cast(p_size AS string) || '）'
            WHEN 9 THEN '(△' || cast(p_size AS string) || '.75)'
            WHEN 10 THEN p_name
            WHEN 11 THEN '※１,※２ ' || cast(p_size AS string) || '.25'
            WHEN 12 THEN ' ' || cast(p_size AS string) || ' '
            WHEN 13 THEN '▲' || cast(p_size AS string) || ',000,000'
            ELSE '–' END AS cell_text,
       CASE p_partkey % 13
            WHEN 0 THEN '2024年3月31日'
            WHEN 1 THEN '前連結会計年度(' || cast(2000 + p_size % 25 AS string) || '年' || cast(1 + p_size % 12 AS string) || '月28日)'
            WHEN 2 THEN '自 2023年4月1日 至 2024年3月31日'
            WHEN 3 THEN '前期 自 平成' || cast(1 + p_size % 30 AS string) || '年4月1日 至 平成' || cast(2 + p_size % 30 AS string) || '年3月31日'
            WHEN 4 THEN '令和 ' || cast(1 + p_size % 6 AS string) || ' 年 9 月 30 日'
            WHEN 5 THEN '昭和63年12月31日'
            WHEN 6 THEN '当期'
            WHEN 7 THEN ''
            WHEN 8 THEN NULL
            WHEN 9 THEN '自 令和2年4月1日'
            WHEN 10 THEN '２０２３年６月３０日'
            WHEN 11 THEN p_name
            ELSE '第' || cast(p_size AS string) || '期 ' || cast(2000 + p_size % 25 AS string) || '年12月31日' END AS date_text,
       CASE p_partkey % 11
            WHEN 0 THEN '2024-03' WHEN 1 THEN '2024.0' || cast(1 + p_size % 9 AS string)
            WHEN 2 THEN cast(1990 + p_size AS string) || '/' || cast(1 + p_size % 12 AS string)
            WHEN 3 THEN '2026.03予' WHEN 4 THEN '2024-13' WHEN 5 THEN '1850-01' WHEN 6 THEN 'FY2024'
            WHEN 7 THEN '' WHEN 8 THEN NULL WHEN 9 THEN ' 2020-2 ' ELSE '2023/00' END AS period_text,
       CASE p_partkey % 8
            WHEN 0 THEN '（単位：百万円）' WHEN 1 THEN '(単位:千円) ' || p_name WHEN 2 THEN '単位：円'
            WHEN 3 THEN '(百万円)' WHEN 4 THEN '売上高 千円' WHEN 5 THEN '（円）' WHEN 6 THEN p_name
            ELSE '（単位：円） 百万円' END AS unit_text,
       CASE p_partkey % 6
            WHEN 0 THEN '半期報告書－第' || cast(p_size AS string) || '期' WHEN 1 THEN '四半期報告書' WHEN 2 THEN NULL
            WHEN 3 THEN '四半期報告書及び半期報告書' WHEN 4 THEN '有価証券報告書' ELSE p_name END AS description,
       CASE WHEN p_partkey % 4 = 0 THEN '120' END AS doc_type_code,
       CASE p_partkey % 12
            WHEN 0 THEN '資産合計' WHEN 1 THEN '流動資産合計' WHEN 2 THEN '売上高' WHEN 3 THEN '営業利益又は営業損失（△）'
            WHEN 4 THEN ' 経常利益 ' WHEN 5 THEN '親会社株主に帰属する当期純利益又は当期純損失' WHEN 6 THEN '純資産合計'
            WHEN 7 THEN '営業活動によるキャッシュ・フロー' WHEN 8 THEN '資産合計額' WHEN 9 THEN '売上総利益'
            WHEN 10 THEN p_name ELSE '中間純損失' END AS item
FROM {part}
"""

# Narrative text per company: a third with numbered lines, a third with blank lines, the rest as it is.
_RISK_WORDS = [w for words in RISK_KEYWORDS.values() for w in words]
_SEVERITIES = [*SEVERITY_HIGH, *SEVERITY_LOW, "通常の", "一定の", "ある程度の"]


def _one_of(words: list[str], number: str) -> str:
    return f"split_part('{'|'.join(words)}', '|', cast(({number}) % {len(words)} + 1 AS int))"


_RISK_SENTENCE = " || ".join([
    _one_of(_RISK_WORDS, "doc_id"), "'および'", _one_of(_RISK_WORDS, "cast(floor(doc_id / 3) AS bigint)"), "'は、'",
    _one_of(_SEVERITIES, "doc_id"), "'影響を'", _one_of(_RISK_WORDS, "doc_id * 7"), "'に与えます。'",
])
_SHORT_SENTENCE = " || ".join([_one_of(_RISK_WORDS, "doc_id * 5 + 3"), "'と'", _one_of(_RISK_WORDS, "doc_id * 11 + 1"), "'の'", _one_of(_SEVERITIES, "doc_id * 3 + 2")])

BRIDGE_SQL["b_text"] = f"""
SELECT cast(1000 + cast(floor(doc_id / 10) AS bigint) AS string) AS ticker,
       'T' || cast(doc_id AS string) AS document_id, doc_id AS seq,
       CASE doc_id % 3 WHEN 0 THEN '(1) ' || {_RISK_SENTENCE} || replace(text, chr(10), chr(10) || ' (2) ' || {_SHORT_SENTENCE})
            WHEN 1 THEN replace(text, chr(10), chr(10) || chr(10) || {_SHORT_SENTENCE}) || {_RISK_SENTENCE} ELSE text END AS text
FROM {{documents}}
"""

# Report pages as text: statement headers, unit, date and item lines, then the whole document text.
BRIDGE_SQL["b_pages"] = """
SELECT 'P' || cast(cast(floor(doc_id / 8) AS bigint) AS string) AS document_id,
       cast(doc_id % 8 + 1 AS int) AS page_no,
       CASE WHEN doc_id % 8 = 0 THEN '①【連結貸借対照表】' || chr(10)
            WHEN doc_id % 8 = 3 THEN '②【四半期連結損益計算書及び四半期連結包括利益計算書】' || chr(10)
            WHEN doc_id % 8 = 4 AND doc_id % 3 = 0 THEN '【損益計算書】' || chr(10)
            WHEN doc_id % 8 = 6 THEN '【中間キャッシュ・フロー計算書】' || chr(10) ELSE '' END
       || CASE doc_id % 5 WHEN 0 THEN '(単位：千円)' || chr(10) WHEN 1 THEN '（単位：百万円）' || chr(10) ELSE '' END
       || CASE doc_id % 7
            WHEN 0 THEN '前期 自 2022年4月1日 当期 自 2023年4月1日' || chr(10) || '至 2023年3月31日 至 2024年3月31日' || chr(10)
            WHEN 1 THEN '2023年3月31日 2024年3月31日' || chr(10)
            WHEN 2 THEN '自 平成30年4月1日 至 平成31年3月31日' || chr(10)
            WHEN 3 THEN '令和5年9月30日 2023年9月30日' || chr(10)
            WHEN 4 THEN '2024年12月31日' || chr(10) ELSE '' END
       || '資産合計  ' || cast(n_chars AS string) || '  ' || cast(n_chars + doc_id % 10 AS string) || chr(10)
       || CASE WHEN doc_id % 4 < 2 THEN '売上高  △' || cast(n_chars % 977 AS string) || '  (1,' || lpad(cast(doc_id % 1000 AS string), 3, '0') || ')' || chr(10) ELSE '' END
       || CASE WHEN doc_id % 6 = 1 THEN '営業利益又は営業損失 ' || cast(doc_id AS string) || chr(10) ELSE '' END
       || text || CASE WHEN doc_id % 11 = 5 THEN chr(10) || '注記（単位：千円）' ELSE '' END AS text
FROM {documents}
"""

# Candidate table extractions of a page: strategy, row and cells.
BRIDGE_SQL["b_candidates"] = """
SELECT 'P' || cast(o_custkey AS string) AS document_id,
       'S' || cast(1 + o_orderkey % 3 AS string) AS strategy_id,
       o_orderkey AS row_no,
       CASE o_orderkey % 7 WHEN 0 THEN '資産合計' WHEN 1 THEN '売上高' WHEN 2 THEN '営業利益' WHEN 3 THEN '経常利益'
            WHEN 4 THEN '純資産合計' WHEN 5 THEN '(単位：千円)' ELSE o_orderpriority END AS c0,
       CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '-' ELSE cast(o_orderkey AS string) END AS c1,
       CASE WHEN o_orderkey % 11 < 3 THEN NULL WHEN o_orderkey % 3 = 2 THEN ' ' ELSE '9' END AS c2,
       cast(CASE WHEN o_orderkey % 11 < 3 THEN 2 ELSE 3 END AS int) AS width,
       CASE WHEN o_orderkey % 9 = 0 THEN '2023年3月31日' WHEN o_orderkey % 9 = 1 THEN '2024年3月31日' END AS period_header
FROM {orders}
"""

# Web research rows: one per company, site and period.
BRIDGE_SQL["b_web_rows"] = """
SELECT ticker, fye_month, suppkey, seq, v,
       CASE (suppkey + seq + v) % 3 WHEN 0 THEN 'yahoo' WHEN 1 THEN 'kabutan' ELSE 'shikiho' END AS site,
       CASE WHEN (suppkey + seq + v) % 3 = 2 THEN NULL
            WHEN seq % 9 = 8 THEN 'n/a'
            ELSE cast(year(period_end) AS string)
                 || CASE WHEN (suppkey + seq + v) % 3 = 0 THEN '-' ELSE '.' END
                 || lpad(cast(month(period_end) AS string), 2, '0')
                 || CASE WHEN year(period_end) = 2025 THEN '予' ELSE '' END END AS period,
       (suppkey + seq) % 12 <> 7 AS collected,
       CASE WHEN (suppkey + seq + v) % 3 = 2 THEN cast(revenue AS string) || '百万円' ELSE cast(revenue AS string) END AS revenue,
       CASE WHEN operating_income < 0 THEN '▲' || cast(0 - operating_income AS string)
            ELSE cast(operating_income AS string) END AS operating_income,
       CASE WHEN seq % 4 = 0 THEN '---' ELSE cast(ordinary_income AS string) END AS ordinary_income,
       cast(net_income AS string) AS net_income,
       cast(net_income % 1000 AS string) || '.5' AS eps
FROM {b_records} WHERE source = 'web'
"""

# Web source envelopes: one row per company and site.
BRIDGE_SQL["b_web_sources"] = """
SELECT cast(cast(floor(1000 + c_custkey / 15) AS bigint) AS string) AS ticker,
       CASE c_custkey % 5 WHEN 0 THEN 'yahoo' WHEN 1 THEN 'kabutan' WHEN 2 THEN 'shikiho' ELSE 'homepage' END AS site,
       'https://site' || cast(c_custkey % 5 AS string) || '.example.com/' || cast(c_custkey AS string) AS url,
       c_custkey AS seq,
       c_custkey % 4 <> 1 AS collected,
       CASE WHEN c_custkey % 4 = 1 THEN 'E' || cast(c_custkey % 3 AS string) END AS error,
       CASE WHEN c_custkey % 4 <> 1 THEN cast(c_acctbal AS string) END AS per_text,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast(c_custkey % 9 AS string) || '.' || cast(c_custkey % 7 AS string) || '倍' END AS pbr_text,
       CASE WHEN c_custkey % 6 = 2 THEN '--' ELSE cast(c_custkey % 5 AS string) || '%' END AS dividend_text,
       CASE WHEN c_custkey % 8 = 3 THEN NULL ELSE cast(c_custkey + 1 AS string) || '億円' END AS market_cap_text,
       c_name AS company_text, c_mktsegment AS segment
FROM {customer}
"""

# Site pages of a company: prices, results, indicators, flash news, lists and an embedded state.
BRIDGE_SQL["b_html"] = """
SELECT c_custkey AS page_id, c_name AS name, c_mktsegment AS segment, c_custkey % 97 AS k, c_nationkey AS nation,
       '<!DOCTYPE html><html><head><title>' || CASE WHEN c_custkey % 10 = 0 THEN '該当なし' ELSE c_name || ' &amp; Co' END || '</title></head><body>'
       || CASE WHEN c_custkey % 10 = 5 THEN '<p>該当する<b>銘柄</b>は<br>ありません</p>' ELSE '' END
       || '<div id="stockinfo_i1"><span class="kabuka">' || cast(c_custkey % 97 AS string) || ',720円</span><span class="change">▲' || cast(c_custkey % 97 AS string) || '</span></div>'
       || '<div id="stockinfo_i2"><table><tr><th>前日終値</th><th>始値</th><th>高値</th><th>出来高</th></tr><tr><td>1,' || lpad(cast(c_custkey % 97 AS string), 3, '0')
       || '</td><td> ' || cast(c_custkey % 97 AS string) || '.5 </td><td>---</td><td>' || cast(c_custkey AS string) || '</td></tr></table></div>'
       || '<div id="financial_td"><table><tr><td>note</td></tr><tr><th>決算期</th><th>売上高</th><th>営業益</th><th>経常利益</th><th>1株益</th></tr>'
       || '<tr><td>2024.03</td><td>' || cast(c_custkey AS string) || ',000</td><td>△' || cast(c_custkey % 97 AS string) || '</td><td>－</td><td>1.5</td></tr>'
       || CASE WHEN c_custkey % 2 = 0 THEN '<tr><td>2023.03</td><td>7</td><td>' || cast(c_nationkey AS string) || '</td></tr>' ELSE '' END || '</table></div>'
       || CASE WHEN c_custkey % 3 <> 0 THEN '<div id="stockinfo_i3"><table><tr><th>PER</th><th>PBR</th><th>利回り</th><th>時価総額</th></tr><tr><td>' || cast(c_custkey % 97 AS string)
            || '.1倍</td><td>－</td><td>2.5%</td><td>' || cast(c_nationkey AS string) || '兆' || cast(c_custkey % 97 AS string) || '億円</td></tr></table></div>' ELSE '' END
       || CASE WHEN c_custkey % 4 = 1 THEN '<div id="kessan_flash"><h3 class="flash-title">Flash ' || c_name || '</h3><time>2026/02/0' || cast(1 + c_custkey % 9 AS string) || '</time><p>up <i>again</i></p></div>'
            WHEN c_custkey % 4 = 2 THEN '<div id="kessan_flash"><a href="/x">' || c_mktsegment || '</a></div>' ELSE '' END
       || '<ul class="news_list"><li><time>2026-02-20</time><a href="/n/' || cast(c_custkey AS string) || '">News ' || c_mktsegment || '</a></li><li>no link</li>'
       || '<li><a href="/m">Second</a><span class="post-date">2026-02-1' || cast(c_custkey % 10 AS string) || '</span></li></ul>'
       || '<section data-section="earnings-forecast"><table><tr><th>売上高</th><td>' || cast(c_custkey AS string) || '百万円</td></tr><tr><th>純利益</th><td>9</td></tr></table></section>'
       || '<section data-section="shareholders"><table><tr><th>name</th></tr><tr><td>' || c_name || '</td><td>' || cast(c_custkey % 97 AS string) || '.0%</td></tr><tr><td>alone</td></tr></table></section>'
       AS html0,
       '"mainStocksPriceBoard":{{"price":"' || CASE WHEN c_custkey % 3 = 0 THEN '---' ELSE cast(c_custkey % 97 AS string) || ',000' END || '","savePrice":"3,700","priceChange":"-' || cast(c_custkey % 97 AS string)
       || '","priceChangeRate":"0.81","shareDividendYield":"1.5"}},"mainStocksDetail":{{"detail":{{"volume":"' || cast(c_custkey AS string) || ',500","tradingValue":"12"}},"referenceIndex":{{"per":"' || cast(c_custkey % 97 AS string)
       || '.2","pbr":"--","shareDividendYield":"' || CASE WHEN c_custkey % 4 = 0 THEN '---' ELSE '2.' || cast(c_custkey % 10 AS string) END || '","totalPrice":"' || cast(c_custkey AS string)
       || '","sharesIssued":"1,000"}}}},"stockPerformance":{{"chartInfo":[{{"date":"202303","amount":' || cast(c_custkey AS string) || ',"profitMargin":' || cast(c_custkey % 97 AS string) || '}},{{"date":"2024","amount":null}}]}}'
       || CASE WHEN c_custkey % 2 = 0 THEN ',"mainStocksNews":{{"articles":[{{"title":"A ' || c_mktsegment || '","url":"/a","date":"d1"}}]}}' ELSE '' END
       || ',"symbolTopics":{{"topics":[{{"date":"d2","sources":[{{"title":"T ' || c_name || '","url":"/t"}},{{"title":"","url":"/u"}}]}}]}}' AS state_body
FROM {customer}
"""

BRIDGE_SQL["b_site_pages"] = """
SELECT page_id, name, segment, k, nation,
       html0 || CASE WHEN page_id % 7 = 6 THEN '' WHEN page_id % 7 = 5 THEN '<script>window.__PRELOADED_STATE__ = {{broken}};</script>'
            ELSE '<script>window.__PRELOADED_STATE__ = {{' || state_body || '}};</script>' END || '</body></html>' AS html
FROM {b_html}
"""

# Raw pages as companies publish them: with a description, a site name and links to investor pages.
BRIDGE_SQL["b_ir_pages"] = """
SELECT page_id, url, replace(replace(html, '<title>',
         CASE page_id % 4 WHEN 0 THEN '<meta name="description" content="Page &amp; ' || cast(page_id AS string) || '">'
              WHEN 1 THEN '<META content=" about us " class="m" name="description">' ELSE '' END
         || CASE WHEN page_id % 3 = 0 THEN '<meta property="og:site_name" content="Site ' || cast(page_id % 10 AS string) || '">' ELSE '' END || '<title>'),
       '<footer>',
         CASE WHEN page_id % 5 = 0 THEN '' ELSE '<a href="/ir/' || cast(page_id AS string) || '.html">IR &gt; News</a><a class="x" href="library/Investor/report.pdf"></a>'
              || '<a href="/irregular/">no</a><a href="/ir/' || cast(page_id AS string) || '.html">again</a><a href="https://x.example/shareholders">holders</a>' END || '<footer>') AS html
FROM {pages}
"""

# Listed companies, some of them too young to have statements.
BRIDGE_SQL["b_companies"] = """
SELECT ticker, company_name, industry, suppkey AS seq FROM {b_securities} WHERE listing NOT IN ('', '非上場')
UNION ALL SELECT ticker || 'N', company_name || ' New', industry, suppkey + 50 FROM {b_securities} WHERE listing NOT IN ('', '非上場') AND suppkey % 4 = 1
"""

# Structured statement tables: one value cell per row.
BRIDGE_SQL["b_cells"] = """
SELECT cast(1000 + l_suppkey AS string) AS ticker,
       'S' || cast(1000 + l_suppkey AS string) || '-' || cast(year(l_shipdate) + 24 AS string)
         || 'q' || cast(quarter(l_shipdate) AS string) AS doc_id,
       CASE l_suppkey % 3 WHEN 0 THEN '160' WHEN 1 THEN '140' ELSE '120' END AS doc_type_code,
       last_day(make_date(cast(year(l_shipdate) + 24 AS int), cast(3 * quarter(l_shipdate) AS int), 1)) AS period_end,
       CASE WHEN l_partkey % 10 < 6 THEN 'income_statement' ELSE 'balance_sheet' END AS section,
       cast(l_partkey % 3 AS int) AS table_no,
       CASE l_partkey % 3 WHEN 0 THEN '（単位：百万円）' WHEN 1 THEN '科目 千円' ELSE '（円）' END AS header,
       cast(floor(l_partkey / 3) % 50 AS int) AS record_no,
       split_part('売上高|営業利益|親会社株主に帰属する当期純利益|売上原価|売上総利益|営業収益|資産合計|純資産合計|流動資産合計|負債合計',
                  '|', cast(l_partkey % 10 + 1 AS int)) AS item,
       l_linenumber AS column_index,
       CASE WHEN l_quantity >= 5 THEN l_extendedprice END AS parsed,
       (l_orderkey * 8 + l_linenumber) * 1000003 + l_partkey AS seq
FROM {lineitem}
"""


# Tables whose SQL holds double quotes inside texts only.
QUOTED_TEXT = {"b_ir_pages"}
# Tables whose rows are built from much narrower ones.
WIDENED = {"b_html"}


def bridge_refs(name: str) -> list[str]:
    """Tables a bridged table reads: single-braced names; doubled braces are literal text."""
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", BRIDGE_SQL[name])


def bridge_order(names: list[str]) -> list[str]:
    """The bridged tables needed for ``names``, each after those it reads."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in RAW_TABLES or name in out:
            return
        for dep in bridge_refs(name):
            visit(dep)
        out.append(name)

    for n in names:
        visit(n)
    return out


def check_sql(deps: list[str], body: str) -> str:
    """A DuckDB statement: the bridged tables as common table expressions, then ``body``."""
    order = bridge_order(deps)
    if not order:
        return body.strip()
    ctes = []
    for name in order:
        refs = {r: r for r in bridge_refs(name)}
        ctes.append(f"{name} AS ({BRIDGE_SQL[name].format(**refs)})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT * FROM ({body.strip()}) AS result"


class Tables:
    """Lazy access to the raw and bridged tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            scan = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            return scan
        text = BRIDGE_SQL[name]
        if "{{" not in text and name not in QUOTED_TEXT:
            text = text.replace('"', "`")
        refs = {r: getattr(self, r) for r in bridge_refs(name)}
        if name in WIDENED:
            # A row of a few numbers becomes a page: the narrow rows are dealt out before that.
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            refs = {r: df.repartition(parts) for r, df in refs.items()}
        return self.spark.sql(text, **refs)

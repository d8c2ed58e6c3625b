"""Queries of the column expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import (
    DATE_RE, FLOAT_RE, s_double, s_filing, s_fy, s_growth, s_half, s_kind, s_quarter, s_r2, s_ratio, s_strip,
)
from ledgerloom.functions import dates as D
from ledgerloom.functions import display as V
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.rules import concepts as C
from ledgerloom.rules import lexicons as L

_UNITS = r"^(?:([^兆]*)兆)?(?:([^億]*)億)?(?:(.*?)百万)?(?:([^万]*)万)?(.*)$"


def _part(i: int) -> str:
    return s_strip(f"replace(regexp_extract(body, '{_UNITS}', {i}), ',', '')")


@query("f1_parse_jp_number", ["b_strings"], rf"""
WITH s AS (SELECT id, num_text, {s_strip('num_text')} AS s FROM b_strings),
b AS (SELECT *, regexp_matches(s, '^[△▲\-−ー]') AS neg,
        {s_strip(r"regexp_replace(" + s_strip(r"regexp_replace(s, '^[△▲\-−ー]', '')") + r", '[%％倍円株]$', '')")} AS body FROM s),
p AS (SELECT *, {_part(1)} AS p1, {_part(2)} AS p2, {_part(3)} AS p3, {_part(4)} AS p4,
        {s_strip("regexp_replace(" + _part(5) + ", '[%％倍円株]$', '')")} AS p5 FROM b),
v AS (SELECT *, CASE WHEN NOT regexp_matches(body, '[兆億万]') THEN {s_double("replace(body, ',', '')")}
        WHEN (p1 <> '' AND NOT regexp_matches(p1, '{FLOAT_RE}')) OR (p2 <> '' AND NOT regexp_matches(p2, '{FLOAT_RE}'))
          OR (p3 <> '' AND NOT regexp_matches(p3, '{FLOAT_RE}')) OR (p4 <> '' AND NOT regexp_matches(p4, '{FLOAT_RE}')) THEN NULL
        ELSE coalesce({s_double('p1')} * 1e12, 0e0) + coalesce({s_double('p2')} * 1e8, 0e0) + coalesce({s_double('p3')} * 1e6, 0e0)
           + coalesce({s_double('p4')} * 1e4, 0e0) + coalesce({s_double('p5')}, 0e0) END AS value FROM p)
SELECT id, CASE WHEN num_text IS NOT NULL AND s NOT IN ('---','--','N/A','NA','n/a','','-','－','—') AND body <> ''
                THEN CASE WHEN neg THEN -value ELSE value END END AS value FROM v""")
def f1(t):
    return t.b_strings.select("id", N.parse_jp_number(F.col("num_text")).alias("value"))


@query("f2_parse_market_cap", ["b_strings"], rf"""
WITH s AS (SELECT id, regexp_replace({s_strip('num_text')}, '[,  ]', '', 'g') AS s FROM b_strings),
p AS (SELECT *, coalesce({s_double("regexp_extract(s, '([0-9.]+)兆', 1)")} * 1e12, 0e0)
          + coalesce({s_double("regexp_extract(s, '([0-9.]+)億', 1)")} * 1e8, 0e0)
          + coalesce({s_double("regexp_extract(s, '([0-9.]+)万', 1)")} * 1e4, 0e0) AS total FROM s)
SELECT id, CASE WHEN s NOT IN ('', '---', '－') THEN CASE WHEN total > 0 THEN total
           ELSE {s_double("regexp_replace(s, '円$', '')")} END END AS market_cap FROM p""")
def f2(t):
    return t.b_strings.select("id", N.parse_market_cap(F.col("num_text")).alias("market_cap"))


@query("f3_parse_plain_number", ["b_strings"], rf"""
WITH s AS (SELECT id, regexp_replace({s_strip('num_text')}, '[  ]', '', 'g') AS s FROM b_strings),
c AS (SELECT *, regexp_replace(replace(regexp_replace(s, '[▲△]', '-', 'g'), ',', ''), '[倍%円]$', '') AS x FROM s)
SELECT id, CASE WHEN s NOT IN ('', '---', '－', '—', 'N/A') THEN {s_double('x')} END AS value FROM c""")
def f3(t):
    return t.b_strings.select("id", N.parse_plain_number(F.col("num_text")).alias("value"))


@query("f4_parse_statement_cell", ["b_strings"], rf"""
WITH s AS (SELECT id, {s_strip(r"regexp_replace(" + s_strip('cell_text') + r", '※[０-９]*[,、]?\s*', '', 'g')")} AS s FROM b_strings),
i AS (SELECT *, CASE WHEN regexp_matches(s, '^[（(]\s*.+?\s*[）)]$') THEN regexp_extract(s, '^[（(]\s*(.+?)\s*[）)]$', 1) ELSE s END AS inr FROM s),
b AS (SELECT *, regexp_replace(regexp_replace(inr, '^[△▲]\s*', ''), '[－﹣−‐]', '-', 'g') AS bare FROM i),
v AS (SELECT *, (inr <> s) OR regexp_matches(inr, '^[△▲]') OR regexp_matches(bare, '^-') AS neg,
        {s_strip("replace(regexp_replace(bare, '^-', ''), ',', '')")} AS x FROM b)
SELECT id, CASE WHEN s NOT IN ('', '-', '－', '―', '—', '−', '–')
   THEN CAST(trunc(CASE WHEN neg THEN -abs({s_double('x')}) ELSE {s_double('x')} END * 1000) AS BIGINT) END AS amount FROM v""")
def f4(t):
    return t.b_strings.select("id", N.parse_statement_cell(F.col("cell_text"), 1000).alias("amount"))


@query("f5_coerce_number", ["b_raw_statements"], f"""
SELECT seq, CASE WHEN {s_strip("replace(NetSales, ',', '')")} NOT IN ('', '-', '--', 'N/A', 'n/a', 'null', 'None')
              THEN {s_double(s_strip("replace(NetSales, ',', '')"))} END AS net_sales,
       CASE WHEN {s_strip("replace(OperatingProfit, ',', '')")} NOT IN ('', '-', '--', 'N/A', 'n/a', 'null', 'None')
              THEN {s_double(s_strip("replace(OperatingProfit, ',', '')"))} END AS operating_profit
FROM b_raw_statements""")
def f5(t):
    return t.b_raw_statements.select(
        "seq",
        N.coerce_number(F.col("NetSales")).alias("net_sales"),
        N.coerce_number(F.col("OperatingProfit")).alias("operating_profit"),
    )


@query("f5_coerce_nested", ["events"], r"""
SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS amount
FROM events""")
def f5_nested(t):
    # The same property as a number, a text, a nested value, a nested amount and a boolean.
    k = F.get_json_object("props", "$.k")
    doc = (
        F.when(F.col("event_id") % 5 == 0, k)
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit('"'), k, F.lit('"')))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit('{"value": '), k, F.lit("}")))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit('{"value": null, "amount": "'), k, F.lit('"}')))
        .otherwise(F.lit("true"))
    )
    return t.events.select("event_id", F.try_parse_json(doc).alias("doc")).select(
        "event_id", N.coerce_nested_number(F.col("doc")).alias("amount")
    )


@query("f6_strict_number", ["b_raw_statements"], rf"""
SELECT seq, CASE WHEN regexp_matches({s_strip("replace(NetSales, ',', '')")}, '^[+-]?[0-9]+$')
              THEN TRY_CAST({s_strip("replace(NetSales, ',', '')")} AS BIGINT) END AS net_sales,
       {s_double(s_strip("replace(EarningsPerShare, ',', '')"))} AS eps
FROM b_raw_statements""")
def f6(t):
    return t.b_raw_statements.select(
        "seq",
        N.strict_integer(F.col("NetSales")).alias("net_sales"),
        N.strict_float(F.col("EarningsPerShare")).alias("eps"),
    )


@query("f7_parse_xbrl_number", ["b_facts"], rf"""
WITH c AS (SELECT seq, document_id, sign, regexp_replace({s_strip('text')}, '[, ]', '', 'g') AS x FROM b_facts),
v AS (SELECT *, CASE WHEN x NOT IN ('', '-', '－', '―') AND regexp_matches(x, '^[+-]?[0-9]+(\.[0-9]+)?$') THEN TRY_CAST(x AS DOUBLE) END AS n FROM c)
SELECT seq, document_id, CASE WHEN sign = '-' THEN -abs(n) ELSE n END AS value FROM v""")
def f7(t):
    return t.b_facts.select(
        "seq", "document_id", N.parse_xbrl_number(F.col("text"), F.col("sign")).alias("value")
    )


@query("f8_normalize_key", ["b_facts"], r"""
SELECT DISTINCT concept, regexp_replace(lower(concept), '[^0-9a-z]+', '', 'g') AS concept_key,
       regexp_replace(lower(context_id), '[^\p{L}\p{N}]+', '', 'g') AS alias_key FROM b_facts""")
def f8(t):
    return t.b_facts.select("concept", "context_id").distinct().select(
        "concept",
        C.concept_key(F.col("concept")).alias("concept_key"),
        C.alias_key(F.col("context_id")).alias("alias_key"),
    ).distinct()


def _s_marked(mark: str) -> str:
    g = lambda i: rf"regexp_extract(h, '{mark}\s*{DATE_RE}', {i})"
    return f"""(CASE WHEN {g(4)} <> '' THEN concat(CASE WHEN {g(1)} <> '' THEN {g(1)}
        ELSE CAST((CASE {g(2)} WHEN '令和' THEN 2018 WHEN '平成' THEN 1988 WHEN '昭和' THEN 1925 END) + TRY_CAST({g(3)} AS INTEGER) AS VARCHAR) END,
        '-', lpad({g(4)}, 2, '0'), '-', lpad({g(5)}, 2, '0')) END)"""


_W = r"([0-9]{4})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
_E = r"(令和|平成|昭和)\s*([0-9]{1,2})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"


@query("f9_parse_jp_date", ["b_strings"], rf"""
WITH h AS (SELECT id, date_text, {s_half('date_text')} AS h FROM b_strings),
p AS (SELECT *, {_s_marked('自')} AS d1, {_s_marked('至')} AS d2,
   CASE WHEN regexp_matches(h, '{_W}') THEN concat(regexp_extract(h, '{_W}', 1), '-', lpad(regexp_extract(h, '{_W}', 2), 2, '0'), '-', lpad(regexp_extract(h, '{_W}', 3), 2, '0'))
        WHEN regexp_matches(h, '{_E}') THEN concat(CASE regexp_extract(h, '{_E}', 1) WHEN '令和' THEN 2018 WHEN '平成' THEN 1988 ELSE 1925 END + CAST(regexp_extract(h, '{_E}', 2) AS INTEGER),
             '-', lpad(regexp_extract(h, '{_E}', 3), 2, '0'), '-', lpad(regexp_extract(h, '{_E}', 4), 2, '0')) END AS d0 FROM h),
r AS (SELECT id, d1 IS NOT NULL AND d2 IS NOT NULL AS b, d0, d1, d2, contains(date_text, '前') AS prior FROM p)
SELECT id, CASE WHEN b THEN d1 END AS period_start, CASE WHEN b THEN d2 ELSE d0 END AS period_end,
       CASE WHEN b THEN 'duration' WHEN d0 IS NOT NULL THEN 'instant' END AS period_type,
       CASE WHEN b OR d0 IS NOT NULL THEN CASE WHEN prior THEN 'prior' ELSE 'current' END END AS label FROM r""")
def f9(t):
    return t.b_strings.select("id", D.column_header(F.col("date_text")).alias("h")).select("id", "h.*")


@query("f10_infer_period_end", ["b_strings"], rf"""
WITH s AS (SELECT id, {s_strip('period_text')} AS s FROM b_strings),
p AS (SELECT id, s, TRY_CAST(regexp_extract(s, '^([0-9]{{4}})[.\-/]([0-9]{{1,2}})', 1) AS INTEGER) AS y,
             TRY_CAST(regexp_extract(s, '^([0-9]{{4}})[.\-/]([0-9]{{1,2}})', 2) AS INTEGER) AS m FROM s)
SELECT id, CASE WHEN m BETWEEN 1 AND 12 AND y BETWEEN 1900 AND 2100 THEN last_day(make_date(y, m, 1)) END AS period_end,
       CASE WHEN m BETWEEN 1 AND 12 AND y BETWEEN 1900 AND 2100 THEN y END AS fiscal_year,
       coalesce(contains(s, '予'), false) AS is_forecast FROM p""")
def f10(t):
    end = D.infer_period_end(F.col("period_text"))
    return t.b_strings.select(
        "id", end.alias("period_end"), F.year(end).alias("fiscal_year"),
        D.is_forecast(F.col("period_text")).alias("is_forecast"),
    )


_KEY = ["ticker", "source", "seq"]
_SKEY = "ticker, source, seq"


@query("f11_fiscal_year", ["b_records"], f"""
SELECT {_SKEY}, {s_fy('period_end', 'fye_month')} AS fiscal_year, CAST(year(period_end) AS INTEGER) AS calendar_year FROM b_records""")
def f11(t):
    return t.b_records.select(
        *_KEY, D.fiscal_year(F.col("period_end"), F.col("fye_month")).alias("fiscal_year"),
        F.year("period_end").alias("calendar_year"),
    )


@query("f12_quarter_label", ["b_records"], f"""
SELECT {_SKEY}, {s_quarter('period_end', 'fye_month')} AS quarter,
       {s_quarter('period_end', '(fye_month - 1)')} AS off_quarter FROM b_records""")
def f12(t):
    return t.b_records.select(
        *_KEY, D.quarter_label(F.col("period_end"), F.col("fye_month")).alias("quarter"),
        D.quarter_label(F.col("period_end"), F.col("fye_month") - 1).alias("off_quarter"),
    )


@query("f13_classify_period", ["b_records"], f"""
SELECT {_SKEY}, {s_kind('period_end', 'period_start', 'fye_month')} AS kind FROM b_records""")
def f13(t):
    return t.b_records.select(
        *_KEY, D.period_kind(F.col("period_end"), F.col("period_start"), F.col("fye_month")).alias("kind")
    )


@query("f14_classify_filing", ["b_records"], f"""
SELECT {_SKEY}, {s_filing('period_end', 'period_start', 'fye_month')} AS filing FROM b_records""")
def f14(t):
    return t.b_records.select(
        *_KEY, D.filing_kind(F.col("period_end"), F.col("period_start"), F.col("fye_month")).alias("filing")
    )


@query("f15_period_starts", ["b_records"], f"""
WITH y AS (SELECT {_SKEY}, fye_month, {s_fy('period_end', 'fye_month')} AS fy FROM b_records),
s AS (SELECT *, CASE WHEN fye_month = 12 THEN make_date(fy, 1, 1) ELSE make_date(fy - 1, fye_month + 1, 1) END AS fy_start FROM y)
SELECT {_SKEY}, fy_start, CAST(fy_start AS DATE) AS q1_start, CAST(fy_start + INTERVAL 3 MONTH AS DATE) AS q2_start,
       CAST(fy_start + INTERVAL 6 MONTH AS DATE) AS q3_start FROM s""")
def f15(t):
    fy = D.fiscal_year(F.col("period_end"), F.col("fye_month"))
    start = lambda q: D.quarter_start(fy, F.col("fye_month"), F.lit(q))
    return t.b_records.select(
        *_KEY, D.fy_start(fy, F.col("fye_month")).alias("fy_start"),
        start("q1").alias("q1_start"), start("q2").alias("q2_start"), start("q3").alias("q3_start"),
    )


@query("f16_period_months", ["b_records"], f"""
WITH m AS (SELECT {_SKEY}, (year(period_end) - year(period_start)) * 12 + month(period_end) - month(period_start) + 1 AS m,
    (year(disclosed_date) - year(period_end)) * -12 + month(period_end) - month(disclosed_date) + 1 AS back FROM b_records)
SELECT {_SKEY}, CAST(CASE WHEN m > 0 THEN m END AS INTEGER) AS months, CAST(CASE WHEN back > 0 THEN back END AS INTEGER) AS back_months FROM m""")
def f16(t):
    return t.b_records.select(
        *_KEY, D.period_months(F.col("period_start"), F.col("period_end")).alias("months"),
        D.period_months(F.col("disclosed_date"), F.col("period_end")).alias("back_months"),
    )


@query("f17_half_year_correction", ["b_filings"], """
WITH m AS (SELECT docID, docTypeCode, period_end, CASE WHEN seq % 3 = 0 THEN period_end ELSE CAST(period_end + INTERVAL 1 DAY AS DATE) END AS manifest_end FROM b_filings)
SELECT docID, CASE WHEN docTypeCode = '160' AND period_end = manifest_end THEN last_day(CAST(period_end - INTERVAL 6 MONTH AS DATE)) ELSE period_end END AS period_end,
       CASE WHEN docTypeCode = '160' AND period_end = manifest_end THEN period_end END AS period_end_original FROM m""")
def f17(t):
    manifest_end = F.when(F.col("seq") % 3 == 0, F.col("period_end")).otherwise(F.date_add("period_end", 1))
    fixed = D.half_year_correction(F.col("period_end"), manifest_end, F.col("docTypeCode"))
    return t.b_filings.select("docID", fixed.alias("f")).select("docID", "f.*")


@query("f18_detect_unit", ["b_strings"], r"""
SELECT id, CASE WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*百万円\s*[）)]?|[（(]\s*百万円\s*[）)]') THEN 1000000
     WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*千円\s*[）)]?|[（(]\s*千円\s*[）)]') THEN 1000
     WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*円\s*[）)]?|[（(]\s*円\s*[）)]') THEN 1 ELSE 1000000 END AS page_multiplier,
   CASE WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*百万円\s*[）)]?|[（(]\s*百万円\s*[）)]') THEN '百万円'
     WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*千円\s*[）)]?|[（(]\s*千円\s*[）)]') THEN '千円'
     WHEN regexp_matches(unit_text, '[（(]?\s*単位\s*[：:]\s*円\s*[）)]?|[（(]\s*円\s*[）)]') THEN '円' ELSE '百万円（デフォルト）' END AS page_label,
   CASE WHEN contains(unit_text, '百万円') THEN 1000000 WHEN contains(unit_text, '千円') THEN 1000
        WHEN regexp_matches(unit_text, '（単位：円）|（円）') THEN 1 ELSE 1000 END AS header_multiplier
FROM b_strings""")
def f18(t):
    unit = T.page_unit(F.col("unit_text"))
    return t.b_strings.select(
        "id", unit["multiplier"].alias("page_multiplier"), unit["label"].alias("page_label"),
        T.header_unit(F.col("unit_text")).alias("header_multiplier"),
    )


@query("f19_ratio_growth", ["b_records"], f"""
SELECT {_SKEY}, {s_r2(s_ratio('net_income', 'total_equity'))} AS roe_percent,
       {s_r2(s_growth('revenue', 'net_income'))} AS growth_percent,
       {s_r2("net_income::DOUBLE / NULLIF(revenue, 0)::DOUBLE")} AS quotient,
       CASE WHEN operating_cf IS NOT NULL OR investing_cf IS NOT NULL THEN coalesce(operating_cf, 0) + coalesce(investing_cf, 0) END AS free_cash_flow
FROM b_records""")
def f19(t):
    c = F.col
    return t.b_records.select(
        *_KEY, N.round2(N.ratio_percent(c("net_income"), c("total_equity"))).alias("roe_percent"),
        N.round2(N.growth_percent(c("revenue"), c("net_income"))).alias("growth_percent"),
        N.round2(N.safe_divide(c("net_income"), c("revenue"))).alias("quotient"),
        N.sum_nullable(c("operating_cf"), c("investing_cf")).alias("free_cash_flow"),
    )


@query("f20_code_convert", ["b_securities"], r"""
SELECT ticker, ticker || '0' AS sec_code, CASE WHEN length(sec_code) = 5 THEN left(sec_code, 4) ELSE sec_code END AS back,
       regexp_matches(ticker, '^[0-9]{4}$') AS valid, regexp_matches(edinet_code, '^[0-9]{4}$') AS valid_other FROM b_securities""")
def f20(t):
    from ledgerloom.operators.securities import is_ticker, sec_code, ticker_of

    c = F.col
    return t.b_securities.select(
        "ticker", sec_code(c("ticker")).alias("sec_code"), ticker_of(c("sec_code")).alias("back"),
        is_ticker(c("ticker")).alias("valid"), is_ticker(c("edinet_code")).alias("valid_other"),
    )


@query("f21_strip_html", ["pages"], rf"""
SELECT page_id, {s_strip(r"regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', E'\n\n', 'g')")} AS text FROM pages""")
def f21(t):
    return t.pages.select("page_id", T.strip_html(F.col("html")).alias("text"))


@query("f22_mask_sensitive", ["documents"], r"""
SELECT doc_id, regexp_replace(regexp_replace(text, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+', '***', 'g'),
       '(?i)(password|passwd|secret|token)\s*[:=]\s*\S+', '***', 'g') AS text FROM documents""")
def f22(t):
    return t.documents.select("doc_id", T.mask_sensitive(F.col("text")).alias("text"))


@query("f23_url_functions", ["pages"], r"""
SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url END AS https_url,
   regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)', 1) AS host,
   regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)', 1) IN ('www.ththre.example.com', 'm.ththth.example.net') AS allowed,
   CASE WHEN ends_with(lower(url), '.pdf') THEN 'pdf' WHEN ends_with(lower(url), '.html') OR ends_with(lower(url), '.htm')
        OR ends_with(lower(url), '/') OR contains(url, '?') THEN 'html' ELSE 'other' END AS link_type,
   regexp_matches(url, '(?i)/(en|fr|de)(/|$)') AS path_match FROM pages""")
def f23(t):
    url = F.col("url")
    return t.pages.select(
        "page_id", T.ensure_https(url).alias("https_url"), T.url_host(url).alias("host"),
        T.url_host(url).isin("www.ththre.example.com", "m.ththth.example.net").alias("allowed"),
        T.link_type(url).alias("link_type"), url.rlike("(?i)/(en|fr|de)(/|$)").alias("path_match"),
    )


@query("f24_in_fiscal_year", ["b_records"], f"""
SELECT {_SKEY}, CASE WHEN fye_month = 12 THEN year(period_end) = year(disclosed_date)
   ELSE (year(period_end) = year(disclosed_date) AND month(period_end) <= fye_month)
     OR (year(period_end) = year(disclosed_date) - 1 AND month(period_end) > fye_month) END AS within FROM b_records""")
def f24(t):
    return t.b_records.select(
        *_KEY, D.in_fiscal_year(F.col("period_end"), F.year("disclosed_date"), F.col("fye_month")).alias("within")
    )


@query("f25_display_format", ["b_records"], rf"""
WITH m AS (SELECT *, (year(period_end) - year(period_start)) * 12 + month(period_end) - month(period_start) + 1 AS m FROM b_records)
SELECT {_SKEY}, CASE WHEN revenue IS NULL THEN 'N/A' ELSE format('{{:,.0f}}', round_even(revenue::DOUBLE / 1e6, 0) + 0e0) END AS man_yen,
  CASE WHEN revenue IS NULL THEN CASE WHEN suppkey % 2 = 0 THEN '—†' ELSE 'N/A' END
       ELSE format('{{:,.1f}}', round_even(revenue::DOUBLE / 1e8 * 1e1, 0) / 1e1 + 0e0) END AS oku_yen,
  CASE WHEN net_income IS NULL THEN 'N/A' ELSE format('{{:.2f}}', round_even(net_income::DOUBLE / 7e0 * 1e2, 0) / 1e2 + 0e0) || '%' END AS raw,
  CASE WHEN m IS NULL OR m = 12 THEN CAST(year(period_end) AS VARCHAR) ELSE year(period_end) || ' (' ||
     CASE m WHEN 3 THEN '四半期' WHEN 6 THEN '半期' WHEN 9 THEN '3Q累計' ELSE m || 'M' END || ')' END AS fiscal_year,
  CASE statement_type WHEN 'standalone' THEN '単体' WHEN 'consolidated' THEN '連結' ELSE '-' END AS statement,
  CASE WHEN length(document_id || ' ' || company_name) > 20 THEN left(document_id || ' ' || company_name, 17) || '...' ELSE document_id || ' ' || company_name END AS short_text
FROM m""")
def f25(t):
    c = F.col
    return t.b_records.select(
        *_KEY,
        V.display_value(c("revenue"), "man_yen", True).alias("man_yen"),
        V.display_value(c("revenue"), "oku_yen", True, absent=c("suppkey") % 2 == 0).alias("oku_yen"),
        V.display_value(c("net_income") / 7.0, suffix="%").alias("raw"),
        V.fiscal_year_display(F.year("period_end"), D.period_months(c("period_start"), c("period_end"))).alias("fiscal_year"),
        V.statement_label(c("statement_type")).alias("statement"),
        V.shorten(F.concat_ws(" ", c("document_id"), c("company_name")), 20).alias("short_text"),
    )


@query("f26_doc_type", ["b_strings"], """
SELECT id, coalesce(doc_type_code, CASE WHEN contains(replace(description, '四半期報告書', ''), '半期報告書') THEN '160' END) AS doc_type FROM b_strings""")
def f26(t):
    return t.b_strings.select("id", D.doc_type(F.col("doc_type_code"), F.col("description")).alias("doc_type"))


@query("f27_fye_month", ["b_securities"], r"""
SELECT ticker, coalesce(TRY_CAST(regexp_extract(fye_text, '([0-9]{1,2})月', 1) AS INTEGER),
                        TRY_CAST(regexp_extract(fye_text, '([0-9]{1,2})/[0-9]{1,2}', 1) AS INTEGER)) AS fye_month FROM b_securities""")
def f27(t):
    return t.b_securities.select("ticker", D.fye_month(F.col("fye_text")).alias("fye_month"))


@query("f28_json_path_value", ["events"], """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS BIGINT) AS missing FROM events""")
def f28(t):
    doc = F.try_parse_json("props")
    return t.events.select(
        "event_id", F.try_variant_get(doc, "$.k", "bigint").alias("k"),
        F.try_variant_get(doc, "$.a.b", "bigint").alias("missing"),
    )


@query("f29_context_priority", ["b_facts"], """
WITH c AS (SELECT DISTINCT context_id, lower(context_id) AS n FROM b_facts)
SELECT context_id, CAST((CASE WHEN contains(n, 'currentyear') THEN 100 ELSE 0 END) + (CASE WHEN contains(n, 'currentquarter') THEN 50 WHEN contains(n, 'current') THEN 60 ELSE 0 END)
  + (CASE WHEN contains(n, 'nonconsolidated') THEN -25 WHEN contains(n, 'consolidated') THEN 40 ELSE 0 END)
  + (CASE WHEN contains(n, 'prior') OR contains(n, 'previous') THEN -80 ELSE 0 END) AS INTEGER) AS priority FROM c""")
def f29(t):
    return t.b_facts.select("context_id").distinct().select(
        "context_id", C.context_priority(F.col("context_id")).alias("priority")
    )


_XBRL_VALUES = ", ".join(f"('{a}', '{c}')" for c, names in C.XBRL_ALIASES.items() for a in names)


@query("f30_concept_map", ["b_facts"], f"""
SELECT f.concept, m.canonical, count(*) AS facts FROM b_facts f
LEFT JOIN (VALUES {_XBRL_VALUES}) m(alias, canonical) ON m.alias = regexp_replace(lower(f.concept), '[^0-9a-z]+', '', 'g')
GROUP BY f.concept, m.canonical""")
def f30(t):
    return t.b_facts.groupBy("concept").agg(F.count("*").alias("facts")).select(
        "concept", C.canonical_concept(F.col("concept")).alias("canonical"), "facts"
    )


@query("f31_alias_pick", ["b_raw_statements"], f"""
SELECT seq, CASE WHEN seq % 3 = 0 THEN coalesce({s_double(s_strip("replace(CASE WHEN seq % 2 = 0 THEN NetSales END, ',', '')"))},
        {s_double(s_strip("replace(OperatingProfit, ',', '')"))}, {s_double(s_strip("replace(NetSales, ',', '')"))})
   ELSE coalesce({s_double(s_strip("replace(OperatingProfit, ',', '')"))}, {s_double(s_strip("replace(NetSales, ',', '')"))}) END AS picked
FROM b_raw_statements""")
def f31(t):
    from ledgerloom.operators.records import pick_number

    c = F.col
    section = F.when(
        c("seq") % 3 == 0,
        F.create_map(
            F.lit("Net_Sales"), F.when(c("seq") % 2 == 0, c("NetSales")), F.lit("Op. Profit"), c("OperatingProfit")
        ),
    ).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    record = F.create_map(F.lit("op-profit"), c("OperatingProfit"), F.lit("netsales"), c("NetSales"))
    primary_names = ["net_sales", "op_profit"]
    return t.b_raw_statements.select(
        "seq",
        F.when(c("seq") % 3 == 0, pick_number(section, record, primary_names))
        .otherwise(pick_number(section, record, list(reversed(primary_names)))).alias("picked"),
    )

"""Queries: web page extraction, checked against the values the pages were built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.operators import html as O

DEPS = ["b_html"]


def parts(t, *wanted):
    return O.page_parts(t.b_site_pages, *wanted)


def states(t):
    return O.embedded_state(t.b_site_pages)


@query("p6_not_found_page", DEPS, "SELECT page_id, page_id % 10 IN (0, 5) AS not_found FROM b_html")
def p6(t):
    return O.not_found_pages(parts(t, "titles", "notices"))


@query("h3_page_news", DEPS, """
SELECT page_id, 1 AS item_no, 'News ' || segment AS title, '/n/' || page_id AS href, '2026-02-20' AS date FROM b_html
UNION ALL SELECT page_id, 3, 'Second', '/m', '2026-02-1' || page_id % 10 FROM b_html""")
def h3(t):
    return O.page_news(parts(t, "items"))


@query("h4_html_tables", DEPS, """
SELECT page_id, header, cell FROM b_html, LATERAL (VALUES ('前日終値', '1,' || lpad(CAST(k AS VARCHAR), 3, '0')), ('始値', k || '.5'), ('高値', '---'), ('出来高', CAST(page_id AS VARCHAR)),
 ('決算期', '2024.03'), ('売上高', page_id || ',000'), ('営業益', '△' || k), ('経常利益', '－'), ('1株益', '1.5'), ('name', name), ('name', 'alone')) v(header, cell)
UNION ALL SELECT page_id, header, cell FROM b_html, LATERAL (VALUES ('決算期', '2023.03'), ('売上高', '7'), ('営業益', CAST(nation AS VARCHAR))) v(header, cell) WHERE page_id % 2 = 0
UNION ALL SELECT page_id, header, cell FROM b_html, LATERAL (VALUES ('PER', k || '.1倍'), ('PBR', '－'), ('利回り', '2.5%'), ('時価総額', nation || '兆' || k || '億円')) v(header, cell) WHERE page_id % 3 <> 0
UNION ALL SELECT page_id, '売上高', '純利益' FROM b_html""")
def h4(t):
    # Below the first heading row of a definition table its next heading is an ordinary cell.
    return O.html_tables(parts(t, "rows")).select("page_id", "header", "cell")


@query("h4_table_results", DEPS, """
SELECT page_id, '2024.03' AS period, page_id * 1e3 AS revenue, -k::DOUBLE AS operating_income, NULL::DOUBLE AS ordinary_income, NULL::DOUBLE AS net_income, 15e-1 AS eps FROM b_html
UNION ALL SELECT page_id, '2023.03', 7e0, nation::DOUBLE, NULL, NULL, NULL FROM b_html WHERE page_id % 2 = 0""")
def h4_results(t):
    return O.table_results(parts(t, "rows")).drop("row_no")


@query("h4_table_prices", DEPS, """
SELECT page_id, k * 1e3 + 720 AS current, -k::DOUBLE AS change, 1e3 + k AS prev_close, k + 5e-1 AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, page_id::DOUBLE AS volume,
 CASE WHEN page_id % 3 <> 0 THEN CAST(k || '.1' AS DOUBLE) END AS per, NULL::DOUBLE AS pbr, CASE WHEN page_id % 3 <> 0 THEN 25e-1 END AS dividend_yield,
 CASE WHEN page_id % 3 <> 0 AND nation * 1e12 + k * 1e8 > 0 THEN nation * 1e12 + k * 1e8 END AS market_cap FROM b_html""")
def h4_prices(t):
    return O.table_prices(parts(t, "rows", "blocks"))


_LIVE = "page_id % 7 < 5"


@query("h5_embedded_state", DEPS, f"""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 37e2 ELSE k * 1e3 END AS current, -k::DOUBLE AS change, 81e-2 AS change_percent, CAST(page_id || '500' AS BIGINT) AS volume, 12e0 AS turnover,
  CAST(k || '.2' AS DOUBLE) AS per, NULL::DOUBLE AS pbr, CASE WHEN page_id % 4 = 0 THEN 15e-1 ELSE CAST('2.' || page_id % 10 AS DOUBLE) END AS dividend_yield, page_id * 1e6 AS market_cap, 1000::BIGINT AS shares_outstanding
FROM b_html WHERE {_LIVE}""")
def h5(t):
    return O.state_figures(states(t))


@query("h5_state_performance", DEPS, f"""
SELECT page_id, 0 AS place, '2023-03' AS period, page_id::DOUBLE AS revenue, round_even(page_id::DOUBLE * k::DOUBLE / 1e2, 0) AS operating_income FROM b_html WHERE {_LIVE}
UNION ALL SELECT page_id, 1, '2024', NULL, NULL FROM b_html WHERE {_LIVE}""")
def h5_performance(t):
    return O.state_performance(states(t))


@query("h5_state_news", DEPS, f"""
SELECT page_id, 0 AS place, CASE WHEN page_id % 2 = 0 THEN 'A ' || segment ELSE 'T ' || name END AS title, CASE WHEN page_id % 2 = 0 THEN '/a' ELSE '/t' END AS url,
  CASE WHEN page_id % 2 = 0 THEN 'd1' ELSE 'd2' END AS date FROM b_html WHERE {_LIVE}""")
def h5_news(t):
    return O.state_news(states(t))


@query("h6_definition_tables", DEPS, """
SELECT page_id, 'earnings-forecast' AS section, '売上高' AS name, page_id || '百万円' AS value FROM b_html UNION ALL SELECT page_id, 'earnings-forecast', '純利益', '9' FROM b_html""")
def h6(t):
    return O.definition_tables(parts(t, "rows")).drop("row_no")


@query("h6_shareholders", DEPS, "SELECT page_id, name, k || '.0%' AS ratio FROM b_html")
def h6_shareholders(t):
    return O.shareholder_rows(parts(t, "rows")).drop("row_no")


@query("h7_earnings_flash", DEPS, """
SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'Flash ' || name ELSE segment END AS title, CASE WHEN page_id % 4 = 1 THEN '2026/02/0' || (1 + page_id % 9) END AS date,
  CASE WHEN page_id % 4 = 1 THEN 'upagain' END AS content FROM b_html WHERE page_id % 4 IN (1, 2)""")
def h7(t):
    return O.earnings_flash(parts(t, "blocks"))

"""Queries: narrative text, statement pages and plain page extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_strip
from ledgerloom.functions import text as T
from ledgerloom.operators import narrative as O
from ledgerloom.operators import pages as P
from ledgerloom.rules import lexicons as L
from ledgerloom.rules.concepts import BS_FIELDS, ITEM_ALIASES


_MARK = r"(?m)^[\s　]*(?:\(\p{Nd}+\)|\p{Nd}+[.)）]|[①-⑳])"
_CUT = "chr(1)"
S_PARA = rf"""cut AS (SELECT ticker, document_id, seq, text, string_split(regexp_replace(text, '{_MARK}', {_CUT}, 'g'), {_CUT}) AS a FROM b_text),
pieces AS (SELECT *, CASE WHEN len(a) > 1 THEN a ELSE string_split(regexp_replace(text, '\n\n+', {_CUT}, 'g'), {_CUT}) END AS b FROM cut),
kept AS (SELECT ticker, document_id, seq, text, list_filter(list_transform(b, lambda x: {s_strip('x')}), lambda x: length(x) >= 20) AS k FROM pieces),
final AS (SELECT ticker, document_id, seq, CASE WHEN len(k) > 0 THEN k WHEN {s_strip('text')} <> '' THEN [{s_strip('text')}] ELSE [] END AS k FROM kept),
para AS (SELECT ticker, document_id, seq, CAST(unnest(generate_series(0, len(k) - 1)) AS INTEGER) AS place, unnest(k) AS text FROM final)"""


def _hits(words: list[str]) -> str:
    return "(" + " + ".join(f"(length(text) - length(replace(text, '{w}', ''))) // {len(w)}" for w in words) + ")"


_H = {c: _hits(w) for c, w in L.RISK_KEYWORDS.items()}
_TOP = f"greatest({', '.join(_H[c] for c in _H)})"
_CAT = "CASE WHEN " + _TOP + " = 0 THEN 'other_risk' " + " ".join(f"WHEN {h} = {_TOP} THEN '{c}'" for c, h in _H.items()) + " END"
_ANYW = lambda words: "(" + " OR ".join(f"contains(text, '{w}')" for w in words) + ")"
S_ITEMS = S_PARA + f""",
items AS (SELECT *, {_CAT} AS category, CASE WHEN {_ANYW(L.SEVERITY_HIGH)} THEN 'high' WHEN {_ANYW(L.SEVERITY_LOW)} THEN 'low' ELSE 'medium' END AS severity FROM para)"""


def items(t):
    return O.risk_items(t.b_text)


@query("t1_split_paragraphs", ["b_text"], f"WITH {S_PARA} SELECT document_id, place, text FROM para")
def t1(t):
    return O.paragraphs(t.b_text).select("document_id", "place", "text")


@query("t2_classify_category", ["b_text"], f"WITH {S_ITEMS} SELECT document_id, place, category FROM items")
def t2(t):
    return items(t).select("document_id", "place", "category")


@query("t3_severity", ["b_text"], f"WITH {S_ITEMS} SELECT document_id, place, severity FROM items")
def t3(t):
    return items(t).select("document_id", "place", "severity")


_CATS = ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in L.RISK_CATEGORIES)


@query("a17_risk_summary", ["b_text"], f"""WITH {S_ITEMS} SELECT ticker, count(*) AS total_risks, {_CATS},
  count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE severity = 'medium') AS medium, count(*) FILTER (WHERE severity = 'low') AS low FROM items GROUP BY ticker""")
def a17(t):
    return O.risk_summary(items(t))


_LABELS = ", ".join(f"('{k}', '{v}', {k in L.REQUIRED_RISK_LABELS})" for k, v in {**L.REQUIRED_RISK_LABELS, **L.EXTRA_RISK_LABELS}.items())


@query("a18_risk_level_table", ["b_text"], f"""WITH {S_ITEMS},
f AS (SELECT ticker, category, max(CASE severity WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS s, count(*) AS n, arg_min(text, (seq, place)) AS text FROM items GROUP BY ALL),
x AS (SELECT t.ticker, l.category, l.label, l.required FROM (SELECT DISTINCT ticker FROM items) t, (VALUES {_LABELS}) l(category, label, required)),
j AS (SELECT x.*, f.s, f.n, trim(replace(f.text, E'\\n', ' ')) AS text FROM x LEFT JOIN f USING (ticker, category) WHERE required OR f.n IS NOT NULL)
SELECT ticker, category, label, CASE s WHEN 3 THEN '高' WHEN 2 THEN '中' WHEN 1 THEN '低' ELSE '-' END AS level, coalesce(n, 0) AS items,
  CASE WHEN n IS NULL THEN '(該当データなし)' WHEN length(text) > 80 THEN left(text, 77) || '...' ELSE text END AS factor FROM j""")
def a18(t):
    return O.risk_level_table(items(t))


# ------------------------------------------------------------------ statement pages

_QI = "(?:四半期|中間)?"
S_HEAD = f"""hd AS (SELECT document_id, page_no, text, CASE WHEN regexp_matches(text, '【{_QI}連結貸借対照表】') THEN 'bs'
  WHEN regexp_matches(text, '【{_QI}連結損益計算書(?:及び{_QI}連結包括利益計算書)?】') THEN 'pl' WHEN regexp_matches(text, '【{_QI}連結キャッシュ・フロー計算書】') THEN 'cf'
  WHEN regexp_matches(text, '【{_QI}貸借対照表】') THEN 'bs' WHEN regexp_matches(text, '【{_QI}損益計算書(?:及び{_QI}包括利益計算書)?】') THEN 'pl'
  WHEN regexp_matches(text, '【{_QI}キャッシュ・フロー計算書】') THEN 'cf' END AS statement FROM b_pages)"""


@query("t4_classify_page", ["b_pages"], f"WITH {S_HEAD} SELECT document_id, page_no, statement FROM hd")
def t4(t):
    return P.statement_headers(t.b_pages).drop("text")


@query("a22_statement_first_page", ["b_pages"], f"WITH {S_HEAD} SELECT document_id, statement, min(page_no) AS page_no FROM hd WHERE statement IS NOT NULL GROUP BY ALL")
def a22(t):
    return P.first_pages(P.statement_headers(t.b_pages))


@query("w6_statement_spans", ["b_pages"], f"""WITH RECURSIVE {S_HEAD},
first AS (SELECT document_id, statement, min(page_no) AS page_no FROM hd WHERE statement IS NOT NULL GROUP BY ALL),
span AS (SELECT document_id, page_no, statement, page_no AS first_page FROM first
  UNION ALL SELECT s.document_id, h.page_no, s.statement, s.first_page FROM span s JOIN hd h ON h.document_id = s.document_id AND h.page_no = s.page_no + 1
   WHERE h.statement IS NULL AND regexp_matches(array_to_string(string_split(h.text, chr(10))[1:3], chr(10)), '単位|千円|百万円'))
SELECT * FROM span""")
def w6(t):
    return P.statement_spans(P.statement_headers(t.b_pages))


_START = r"[※０-９\p{Nd}△▲（(－\-]"
_TWO = rf"^(.+?)\s+([※０-９\d△▲（(－\-][^\n]*?)\s+([※０-９\d△▲（(－\-][^\n]*?)$"
_ONE = r"^(.+?)\s+([※０-９\d△▲（(－\-][,\d０-９，．.※]+)$"
_EX, _PRE = {}, []
for _c, _names in ITEM_ALIASES.items():
    for _n in _names:
        if _n not in _EX:
            _EX[_n] = _c
            if _c not in BS_FIELDS and _n not in {a for c in BS_FIELDS for a in ITEM_ALIASES.get(c, ())}:
                _PRE.append((_n, _c))
S_CONCEPT = "CASE " + " ".join(f"WHEN item = '{n}' THEN '{c}'" for n, c in _EX.items()) + " " + " ".join(
    f"WHEN starts_with(item, '{n}') THEN '{c}'" for n, c in _PRE) + " END"


def _lines(pattern: str, two: bool) -> str:
    v2 = s_strip(f"regexp_extract(line, '{pattern}', 3)") if two else "NULL::VARCHAR"
    return rf"""sp AS (SELECT document_id, page_no, string_split(text, chr(10)) AS ls FROM b_pages),
ln AS (SELECT document_id, page_no, CAST(unnest(generate_series(0, len(ls) - 1)) AS INTEGER) AS line_no, unnest(ls) AS line FROM sp),
mt AS (SELECT document_id, page_no, line_no, {s_strip(f"regexp_extract(line, '{pattern}', 1)")} AS item, {s_strip(f"regexp_extract(line, '{pattern}', 2)")} AS value_1, {v2} AS value_2
  FROM ln WHERE regexp_matches(line, '{pattern}')),
li AS (SELECT *, {S_CONCEPT} AS concept FROM mt)"""


@query("t5_text_lines", ["b_pages"], f"WITH {_lines(_TWO, True)} SELECT * FROM li WHERE concept IS NOT NULL")
def t5(t):
    return P.text_lines(t.b_pages)


@query("t5_text_lines_one_value", ["b_pages"], f"WITH {_lines(_ONE, False)} SELECT * FROM li WHERE concept IS NOT NULL")
def t5_one(t):
    return P.text_lines(t.b_pages, columns=2)


@query("j11_concept_alias", ["b_strings"], f"""SELECT id, {S_CONCEPT} AS concept FROM (SELECT id, {s_strip('item')} AS item FROM b_strings)""")
def j11(t):
    from ledgerloom.rules.concepts import item_concept

    return t.b_strings.select("id", item_concept(F.col("item")).alias("concept"))


_D = r"([0-9]{4})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
_E = r"(令和|平成|昭和)\s*([0-9]{1,2})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
_DW = r"(?:[0-9]{4}\s*年|(?:令和|平成|昭和)\s*[0-9]{1,2}\s*年)\s*[0-9]{1,2}\s*月\s*[0-9]{1,2}\s*日"


def _s_iso(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, '{_D}') THEN concat(regexp_extract({x}, '{_D}', 1), '-', lpad(regexp_extract({x}, '{_D}', 2), 2, '0'), '-', lpad(regexp_extract({x}, '{_D}', 3), 2, '0')) "
            f"ELSE concat(CASE regexp_extract({x}, '{_E}', 1) WHEN '令和' THEN 2018 WHEN '平成' THEN 1988 ELSE 1925 END + TRY_CAST(regexp_extract({x}, '{_E}', 2) AS INTEGER), '-', "
            f"lpad(regexp_extract({x}, '{_E}', 3), 2, '0'), '-', lpad(regexp_extract({x}, '{_E}', 4), 2, '0')) END)")


@query("t6_page_periods", ["b_pages"], rf"""
WITH h AS (SELECT document_id, page_no, text AS t FROM b_pages),
x AS (SELECT document_id, page_no, list_transform(regexp_extract_all(t, '自\s*{_DW}'), lambda m: {_s_iso('m')}) AS s, list_transform(regexp_extract_all(t, '至\s*{_DW}'), lambda m: {_s_iso('m')}) AS e,
   list_concat(list_transform(regexp_extract_all(t, '{_D}'), lambda m: {_s_iso('m')}), list_transform(regexp_extract_all(t, '{_E}'), lambda m: {_s_iso('m')})) AS i FROM h),
d AS (SELECT *, list_filter(i, lambda v, n: list_position(i, v) = n) AS u, len(s) > 0 AND len(s) = len(e) AS pairs FROM x),
r AS (SELECT *, CASE WHEN pairs THEN e ELSE u END AS ends FROM d),
o AS (SELECT *, unnest(generate_series(1, len(ends))) AS k FROM r)
SELECT document_id, page_no, CAST(k - 1 AS INTEGER) AS place, CASE WHEN pairs THEN s[k] END AS period_start, ends[k] AS period_end, CASE WHEN pairs THEN 'duration' ELSE 'instant' END AS period_type,
  CASE WHEN k = 1 AND len(ends) > 1 THEN 'prior' ELSE 'current' END AS label FROM o""")
def t6(t):
    return P.page_period_rows(t.b_pages)


_SC = f"""sc AS (SELECT document_id, strategy_id, count(DISTINCT concept) AS score, count(DISTINCT period_header) AS periods, max(width) AS width,
   CAST(max(coalesce(trim(c1) NOT IN ('', '-', '－', '―', '—', '−', '–'), false)::INT) + max(coalesce(trim(c2) NOT IN ('', '-', '－', '―', '—', '−', '–'), false)::INT) AS INTEGER) AS value_columns
   FROM (SELECT *, {S_CONCEPT} AS concept FROM (SELECT *, trim(c0) AS item FROM b_candidates)) GROUP BY ALL)"""


@query("a23_concept_score", ["b_candidates"], f"WITH {_SC} SELECT * FROM sc")
def a23(t):
    return P.concept_scores(t.b_candidates)


@query("a24_best_candidate", ["b_candidates"], f"""WITH {_SC},
rk AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY periods DESC, score DESC, strategy_id) AS place FROM sc),
w AS (SELECT document_id, score AS ws, greatest(width - 1, 0) AS expected, value_columns AS wv FROM rk WHERE place = 1),
c AS (SELECT rk.*, place > 1 AND wv < expected AND value_columns >= expected AND score >= ws AS replaces FROM rk JOIN w USING (document_id))
SELECT document_id, strategy_id, score, place > 1 AS replaced FROM c QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY replaces DESC, place) = 1""")
def a24(t):
    return P.best_candidate(P.concept_scores(t.b_candidates))


@query("a25_modal_width", ["b_candidates"], """
WITH wd AS (SELECT document_id, strategy_id, width, count(*) AS n, min(row_no) AS f FROM b_candidates GROUP BY ALL),
m AS (SELECT * FROM wd QUALIFY row_number() OVER (PARTITION BY document_id, strategy_id ORDER BY n DESC, f) = 1),
k AS (SELECT b.*, concat(coalesce(c0, ''), '|', coalesce(c1, ''), '|', coalesce(c2, '')) AS row_text FROM b_candidates b JOIN m USING (document_id, strategy_id, width)),
h AS (SELECT *, regexp_matches(row_text, '単位|千円|百万円') AS is_header FROM k)
SELECT document_id, strategy_id, width, row_no, row_text, is_header FROM h WHERE NOT is_header AND trim(c0) <> ''
UNION ALL SELECT document_id, strategy_id, width, min(row_no), row_text, true FROM h WHERE is_header GROUP BY document_id, strategy_id, width, row_text""")
def a25(t):
    return P.modal_width_rows(t.b_candidates)


# ------------------------------------------------------------------ plain page extraction

_UNESC = lambda x: f"replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"
_INNER = lambda x: f"array_to_string(list_transform(string_split(regexp_replace({x}, '<[^>]*>', chr(1), 'g'), chr(1)), lambda p: {s_strip(_UNESC('p'))}), '')"


def _EL(tag: str) -> str:
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    inner = _INNER(f"regexp_extract(html, '{pattern}', 1)")
    return f"CASE WHEN regexp_matches(html, '{pattern}') THEN {inner} END"


@query("h1_page_info", ["b_ir_pages"], rf"""
SELECT page_id, {_EL('title')} AS title, CASE page_id % 4 WHEN 0 THEN 'Page & ' || page_id WHEN 1 THEN 'about us' END AS description,
   coalesce(CASE WHEN page_id % 3 = 0 THEN 'Site ' || page_id % 10 END, {_EL('h1')}, {_EL('title')}) AS company_name FROM b_ir_pages""")
def h1(t):
    from ledgerloom.operators.html import page_info

    return page_info(t.b_ir_pages)


@query("h2_ir_links", ["b_ir_pages"], rf"""
WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 1) AS hs, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 2) AS ts FROM b_ir_pages),
l AS (SELECT page_id, url, unnest(generate_series(0, len(hs) - 1)) AS pos, unnest(hs) AS href, unnest(ts) AS t FROM a),
i AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN href WHEN starts_with(href, '//') THEN split_part(url, ':', 1) || ':' || href
     WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS abs,
   {_INNER('t')} AS title FROM l WHERE regexp_matches(href, '{L.IR_PATH}')),
u AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY page_id, abs ORDER BY pos) = 1)
SELECT page_id, abs AS link_url, CASE WHEN title = '' THEN href ELSE title END AS title,
  CASE WHEN ends_with(lower(href), '.pdf') THEN 'pdf' WHEN regexp_matches(lower(href), '(\.html|\.htm|/)$') OR contains(href, '?') THEN 'html' ELSE 'other' END AS link_type,
  row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1 AS is_ir_page FROM u""")
def h2(t):
    from ledgerloom.operators.html import ir_links

    return ir_links(t.b_ir_pages)

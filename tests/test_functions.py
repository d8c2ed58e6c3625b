"""Column expressions on literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import display as V
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.rules import concepts as C


def test_jp_numbers(values):
    cases = {
        "1,234.56": 1234.56, "1,234": 1234.0, "1兆2,345億": 1234500000000.0, "1,234億5,678万": 123456780000.0,
        "58,757,353": 58757353.0, "5万": 50000.0, "1億": 1e8, "1兆": 1e12, "△1,234": -1234.0, "▲500": -500.0,
        "-1,234": -1234.0, "13.58倍": 13.58, "2.55%": 2.55, "3,720円": 3720.0, "---": None, "": None,
        "1,234百万円": 1234000000.0, "1兆2,345億円": 1234500000000.0, "abc": None, "x億": None, "N/A": None, " ▲1億 ": -1e8,
    }
    assert values(list(cases), N.parse_jp_number) == list(cases.values())
    assert values([None], N.parse_jp_number) == [None]


def test_market_cap_and_plain(values):
    assert values(["1兆2,345億円", "500億", "1,000円", "---", "x"], N.parse_market_cap) == [1234500000000.0, 5e10, 1000.0, None, None]
    assert values(["1,234", "▲5.5%", "△7", "12倍", "－", "n"], N.parse_plain_number) == [1234.0, -5.5, -7.0, 12.0, None, None]


def test_statement_cells(values):
    cells = ["1,234", "(567)", "△ 89", "－12", "※１ 3,000", "―", "", None, "（4）", "abc", "1.9", "(△2.5)"]
    assert values(cells, lambda c: N.parse_statement_cell(c)) == [1234, -567, -89, -12, 3000, None, None, None, -4, None, 1, -2]
    assert values(["△1.5"], lambda c: N.parse_statement_cell(c, 1000)) == [-1500]


def test_strict_and_lenient(values):
    texts = ["1,000", "1000.9", " 7 ", "", "-", "N/A", "NaN", "inf", "12d", "-5", "null"]
    assert values(texts, N.strict_integer) == [1000, None, 7, None, None, None, None, None, None, -5, None]
    assert values(texts, N.coerce_number) == [1000.0, 1000.9, 7.0, None, None, None, None, None, None, -5.0, None]


def test_nested_numbers(values):
    docs = ['5', '"1,200"', 'true', '{"value": null, "amount": "3"}', '{"current": 4}', '{"other": 1}', 'null', '{"value": true, "fy": 2}']
    got = values(docs, lambda c: N.coerce_nested_number(F.try_parse_json(c)))
    assert got == [5.0, 1200.0, None, 3.0, 4.0, None, None, 2.0]


def test_xbrl_number(values):
    assert values(["1,234", "-", "－", " 12.5 ", "n/a", "-3"], lambda c: N.parse_xbrl_number(c, F.lit("-"))) == [-1234.0, None, None, -12.5, None, -3.0]
    assert values(["-3"], lambda c: N.parse_xbrl_number(c, F.lit(None).cast("string"))) == [-3.0]


def test_ratios(spark):
    row = spark.range(1).select(
        N.round2(N.ratio_percent(F.lit(80), F.lit(2000))).alias("roe"), N.ratio_percent(F.lit(1), F.lit(0)).alias("zero"),
        N.growth_percent(F.lit(5.0), F.lit(-10.0)).alias("up"), N.growth_percent(F.lit(5.0), F.lit(0.0)).alias("none"),
        N.sum_nullable(F.lit(None).cast("double"), F.lit(None).cast("double")).alias("both"),
        N.sum_nullable(F.lit(None).cast("double"), F.lit(3.0)).alias("one"),
        N.round2(F.lit(0.125)).alias("even"), N.round2(F.lit(1.005)).alias("below"),
    ).first()
    assert tuple(row) == (4.0, None, 150.0, None, None, 3.0, 0.12, 1.0)


def test_dates(values):
    heads = ["自 2023年4月1日 至 2024年3月31日", "前期 平成27年３月31日", "令和 5 年 9 月 30 日", "当期", None, "自 平成30年4月1日 至 令和元年"]
    got = values(heads, lambda c: D.column_header(c))
    assert [tuple(g) if g else None for g in got] == [
        ("2023-04-01", "2024-03-31", "duration", "current"), (None, "2015-03-31", "instant", "prior"),
        (None, "2023-09-30", "instant", "current"), None, None, (None, "2018-04-01", "instant", "current"),
    ]
    ends = ["2024-02", "2023.02", "2024/3", "2024-13", "1850-01", "FY", "", None, "2026.03予"]
    day = dt.date
    assert values(ends, D.infer_period_end) == [day(2024, 2, 29), day(2023, 2, 28), day(2024, 3, 31), None, None, None, None, None, day(2026, 3, 31)]


@pytest.mark.parametrize(
    "end,start,fye,filing,kind",
    [
        ("2024-03-31", "2023-04-01", 3, "annual", "annual"), ("2024-03-31", None, 3, "annual", "annual"),
        ("2024-03-31", "2023-10-01", 3, "h1", "quarterly"), ("2023-06-30", "2023-04-01", 3, "q1", "quarterly"),
        ("2023-09-30", "2023-07-01", 3, "q2", "quarterly"), ("2024-09-30", "2024-04-01", 3, "h1", "quarterly"),
        ("2023-09-30", "2023-04-01", 3, "q2", "quarterly"), ("2023-12-31", "2023-10-01", 3, "q3", "quarterly"),
        ("2023-05-31", None, 3, "unknown", "quarterly"), ("2023-12-31", "2023-01-01", 12, "annual", "annual"),
        ("2024-03-31", "2024-01-01", 3, "unknown", "quarterly"),
    ],
)
def test_filing_kinds(spark, end, start, fye, filing, kind):
    row = spark.createDataFrame([(end, start)], "e string, s string").select(
        F.col("e").cast("date").alias("e"), F.col("s").cast("date").alias("s")
    ).select(D.filing_kind(F.col("e"), F.col("s"), F.lit(fye)), D.period_kind(F.col("e"), F.col("s"), F.lit(fye))).first()
    assert tuple(row) == (filing, kind)


def test_fiscal_dates(spark):
    d = F.lit("2023-11-30").cast("date")
    row = spark.range(1).select(
        D.fiscal_year(d, F.lit(3)).alias("fy"), D.quarter_label(d, F.lit(3)).alias("odd"), D.quarter_label(d, F.lit(11)).alias("full"),
        D.fy_start(F.lit(2024), F.lit(3)).alias("s"), D.fy_start(F.lit(2024), F.lit(12)).alias("s12"),
        D.quarter_start(F.lit(2024), F.lit(9), F.lit("q3")).alias("q3"), D.half_year_end(F.lit("2024-08-31").cast("date")).alias("half"),
        D.period_months(F.lit("2023-04-01").cast("date"), F.lit("2024-03-31").cast("date")).alias("m"),
    ).first()
    day = dt.date
    assert tuple(row) == (2024, "M11", "FY", day(2023, 4, 1), day(2024, 1, 1), day(2024, 4, 1), day(2024, 2, 29), 12)


def test_small_lookups(values):
    assert values(["3月31日", "12月", "03/31", "x", None], D.fye_month) == [3, 12, 3, None, None]
    assert values(["半期報告書", "四半期報告書", None], lambda c: D.doc_type(F.lit(None).cast("string"), c)) == ["160", None, None]
    assert values(["Net Sales", "jp:TotalAssets", "Assets-Total", "operating_cf"], C.canonical_concept) == ["revenue", None, "total_assets", "operating_cf"]
    items = ["資産合計", "流動資産合計", "資産合計額", "営業利益又は営業損失", "純資産合計", " 売上高 ", "その他"]
    assert values(items, C.item_concept) == ["total_assets", "current_assets", None, "operating_income", "total_equity", "revenue", None]
    contexts = ["CurrentYearDuration", "CurrentYearInstant_ConsolidatedMember", "CurrentYearDuration_NonConsolidatedMember", "CurrentQuarterDuration", "Prior1YearInstant"]
    assert values(contexts, C.context_priority) == [160, 200, 135, 50, -80]


def test_text(values):
    numbered = "(1) " + "a" * 25 + "\n  2. " + "b" * 30 + "\n③" + "c" * 22 + "\n4) short"
    assert values([numbered], T.split_paragraphs) == [["a" * 25, "b" * 30, "c" * 22]]
    blocks = "x" * 20 + "\n\n\n" + "y" * 21 + " (1)(2)"
    assert values([blocks, "tiny", "", None], T.split_paragraphs) == [["x" * 20, "y" * 21 + " (1)(2)"], ["tiny"], [], []]
    assert values(["為替と金利", "訴訟", "取引先の信用と為替", "なし", "為替 取引先"], T.risk_category) == [
        "market_risk", "regulatory_risk", "credit_risk", "other_risk", "market_risk"]
    assert values(["重大だが軽微", "限定的", "普通"], T.risk_severity) == ["high", "low", "medium"]
    assert values(["a@b.co password: x1 Token=zz ok"], T.mask_sensitive) == ["*** *** *** ok"]
    assert values(["<p>a</p>\n\n\n\n<b>b</b>"], T.strip_html) == ["a \n\n b"]
    assert values(["①【四半期連結貸借対照表】", "【損益計算書】【連結キャッシュ・フロー計算書】", "貸借対照表"], T.page_statement) == ["bs", "cf", None]


def test_page_periods(values):
    pages = ["前 自 2022年4月1日 当 自 2023年4月1日\n至 2023年3月31日 至 2024年3月31日", "2023年3月31日 2024年3月31日 2023年3月31日", "none"]
    got = [[tuple(p) for p in g] for g in values(pages, lambda c: T.page_periods(c))]
    assert got == [
        [("2022-04-01", "2023-03-31", "duration", "prior"), ("2023-04-01", "2024-03-31", "duration", "current")],
        [(None, "2023-03-31", "instant", "prior"), (None, "2024-03-31", "instant", "current")], [],
    ]


def test_urls(spark):
    rows = [("http://a.jp:80/x/y?q#f", "z.pdf"), ("https://a.jp", "/ir/"), ("https://a.jp/x", "//b.jp/c"), ("https://a.jp/x", "https://c.jp/?p")]
    got = spark.createDataFrame(rows, "b string, h string").select(
        T.url_join(F.col("b"), F.col("h")), T.url_host(F.col("b")), T.link_type(F.col("h"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("http://a.jp:80/x/z.pdf", "a.jp", "pdf"), ("https://a.jp/ir/", "a.jp", "html"), ("https://b.jp/c", "a.jp", "other"),
        ("https://c.jp/?p", "a.jp", "html")]


def test_display(spark):
    row = spark.range(1).select(
        V.display_value(F.lit(1234567890.0), "man_yen", True), V.display_value(F.lit(1234567890.0), "oku_yen", True),
        V.display_value(F.lit(None).cast("double")), V.display_value(F.lit(None).cast("double"), absent=F.lit(True)),
        V.display_value(F.lit(-0.001), suffix="%"), V.fiscal_year_display(F.lit(2024), F.lit(6)), V.period_label(F.lit(5)),
        V.shorten(F.lit("a" * 90)),
    ).first()
    assert tuple(row) == ("1,235", "12.3", "N/A", "—†", "0.00%", "2024 (半期)", "5M", "a" * 77 + "...")


def test_word_places_and_counts(values):
    """All places of overlapping, nested and self-overlapping words, against a plain count of each word."""
    import random

    rng = random.Random(4)
    keywords = {"a": ["災害", "自然災害", "IT", "I"], "b": ["害", "aa", "C++"], "c": ["然災", "自然", "aab"], "d": ["(1)", "品質"]}
    high, low = ["害に", "ba"], ["自", "質"]
    pieces = ["自然災害", "災害に", "IT", "C++", "aaa", "aab", "(1)", "品質", " ", "x", "自", "然"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(150)]
    count = lambda t, words: sum(t.count(w) for w in words)
    want = []
    for t in texts:
        hits = {k: count(t, w) for k, w in keywords.items()}
        top = max(hits.values())
        category = next(k for k, n in hits.items() if n == top) if top else "other_risk"
        want.append((category, "high" if count(t, high) else "low" if count(t, low) else "medium"))
    assert [tuple(r) for r in values(texts, lambda c: T.risk_judgement(c, keywords, high, low))] == want
    assert values(texts, lambda c: T.risk_category(c, keywords)) == [c for c, _ in want]
    assert values(texts, lambda c: T.risk_severity(c, high, low)) == [s for _, s in want]
    assert values([None], T.risk_judgement) == [None]


def test_page_periods_in_one_pass(values):
    pages = ["自2023年4月1日至２０２４年３月３１日", "自 平成30年4月1日 自2022年4月1日 至2023年3月31日", "令和５年9月30日 12023年9月30日 平成2024年1月1日 2023年9月30日", "至 2024年3月31日 3月31日", None]
    got = [None if g is None else [tuple(p)[:2] for p in g] for g in values(pages, lambda c: T.page_periods(c))]
    assert got == [
        [("2023-04-01", "2024-03-31")],
        [(None, "2022-04-01"), (None, "2023-03-31"), (None, "2018-04-01")],
        [(None, "2023-09-30"), (None, "2024-01-01")],
        [(None, "2024-03-31")],
        None,
    ]

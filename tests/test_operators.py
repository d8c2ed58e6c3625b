"""Table operators on small literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes, facts, inventory, merge, narrative, pages, quality, reconcile, records, securities, valuation, web
from ledgerloom.sources import readers
from ledgerloom.sources import xbrl as filing_archives
from ledgerloom.rules.concepts import COMPARE_FIELDS


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture
def xbrl(spark):
    consolidated, plain = "CurrentYearInstant_ConsolidatedMember", "CurrentYearInstant"
    f = spark.createDataFrame(
        [
            ("7203", "D1", "TotalAssets", plain, 1, "900", None), ("7203", "D1", "TotalAssets", consolidated, 2, "1,000", None),
            ("7203", "D1", "TotalAssets", plain, 3, "950", None), ("7203", "D1", "NetSales", "Dur", 4, "10", None),
            ("7203", "D1", "NetSales", "Dur", 5, "12", "-"), ("7203", "D1", "NetSales", "Missing", 6, "99", None),
            ("7203", "D1", "CurrentLiabilities", plain, 7, "100", None), ("7203", "D1", "NoncurrentLiabilities", plain, 8, "50", None),
            ("7203", "D1", "Other", plain, 9, "1", None), ("7203", "D1", "NetAssets", plain, 10, "x", None),
        ],
        "ticker string, document_id string, concept string, context_id string, seq bigint, text string, sign string",
    )
    end = dt.date(2024, 3, 31)
    c = spark.createDataFrame(
        [("D1", plain, "instant", None, end), ("D1", consolidated, "instant", None, end), ("D1", "Dur", "duration", dt.date(2023, 4, 1), end)],
        "document_id string, context_id string, period_type string, start_date date, period_end date",
    )
    return f, c


def test_fact_resolution(xbrl):
    got = rows(facts.resolve_facts(*xbrl), "concept", "value")
    assert got == [("current_liabilities", 100.0), ("noncurrent_liabilities", 50.0), ("revenue", -12.0), ("total_assets", 1000.0)]


def test_period_rows_and_totals(xbrl):
    row = facts.derive_totals(facts.period_rows(*xbrl)).first()
    assert (row.period_type, row.period_start, row.total_assets, row.total_liabilities) == ("mixed", dt.date(2023, 4, 1), 1000.0, 150.0)
    assert row.calculated_fields == ["total_liabilities"]
    assert row.source_context_ids == ["CurrentYearInstant", "CurrentYearInstant_ConsolidatedMember", "Dur"]


def test_latest_corrections(spark):
    name = "jpcrp-asr-001_E1-000_2021-12-31_{}_2022-03-23.xbrl"
    df = spark.createDataFrame(
        [("E1", 1, name.format("01")), ("E1", 2, name.format("02")), ("E1", 3, "other.xbrl"), ("E1", 4, name.format("02"))],
        "ticker string, seq bigint, member string",
    )
    assert rows(facts.latest_corrections(df), "seq") == [(2,), (3,)]


ROW = "ticker string, fye_month int, seq bigint, period_start date, period_end date, disclosed_date date, fiscal_year int, web_source string, eps double, document_id string, statement_type string, " + ", ".join(
    f"{f} bigint" for f in dict.fromkeys([*merge.MERGE_FIELDS, "noncurrent_liabilities"]))


def side(spark, *entries):
    names = [x.split()[0] for x in ROW.split(", ")]
    base = {"ticker": "1", "fye_month": 3, "seq": 1, "period_start": dt.date(2023, 4, 1), "period_end": dt.date(2024, 3, 31), "total_equity": 1}
    return spark.createDataFrame([tuple({**base, **e}.get(n) for n in names) for e in entries], ROW)


@pytest.mark.parametrize(
    "e,w,j,label,revenue",
    [
        (1, 2, 3, "edinet+web+jquants", 1), (1, None, 3, "both", 1), (1, 2, None, "edinet+web", 1), (None, 2, 3, "web+jquants", 2),
        (1, None, None, "edinet", 1), (None, None, 3, "jquants", 3), (None, 2, None, "web", 2),
    ],
)
def test_three_sources(spark, e, w, j, label, revenue):
    mk = lambda v: side(spark, *([] if v is None else [{"revenue": v}]))
    got = merge.merge_entries(merge.filing_entries(mk(e)), merge.statement_entries(mk(j)), merge.web_entries(mk(w))).first()
    assert (got.source, got.revenue, got.fiscal_year, got.quarter) == (label, revenue, 2024, "FY")


def test_merge_fills_nulls_and_is_identity_without_second(spark):
    first = merge.filing_entries(side(spark, {"revenue": 5}))
    second = merge.statement_entries(side(spark, {"revenue": 9, "net_income": 7}))
    got = merge.merge_entries(first, second).first()
    assert (got.revenue, got.net_income, got.source) == (5, 7, "both")
    alone = merge.merge_entries(first, second.limit(0))
    assert rows(alone, *merge.MERGE_FIELDS) == rows(merge.pick_entries(first), *merge.MERGE_FIELDS)


def test_annual_last_and_quarterly_richest_entries(spark):
    q = {"period_end": dt.date(2023, 6, 30), "period_start": dt.date(2023, 4, 1)}
    df = side(
        spark, {"seq": 1, "revenue": 1}, {"seq": 2, "revenue": 2}, {"seq": 3, "revenue": 3, **q}, {"seq": 4, "revenue": 4, "net_income": 4, **q},
        {"seq": 5, "revenue": 5, "net_income": 5, **q}, {"seq": 6, "total_equity": None, "revenue": 6},
    )
    assert rows(merge.pick_entries(merge.filing_entries(df)), "quarter", "revenue") == [("FY", 2), ("Q1", 4)]
    assert rows(merge.pick_entries(merge.statement_entries(df)), "quarter", "revenue") == [("FY", 6), ("Q1", 3)]


def test_verdicts(spark):
    cases = [(None, None, "BOTH_NULL"), (None, 1, "EDINET_NULL"), (1, None, "JQUANTS_NULL"), (0, 0, "MATCH"), (5, 0, "MISMATCH"),
             (10000, 10001, "MATCH"), (100, 102, "MISMATCH"), (0, 5, "MISMATCH")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a bigint, b bigint")
    got = [r[0]["match"] for r in df.select(reconcile.verdict(F.col("a"), F.col("b"), 0.0001)).collect()]
    assert got == [c for _, _, c in cases]


def test_reconcile_invalid_and_one_sided(spark):
    schema = "ticker string, period_end date, " + ", ".join(f"{f} bigint" for f in COMPARE_FIELDS)
    d1, d2, d3 = dt.date(2024, 3, 31), dt.date(2023, 3, 31), dt.date(2022, 3, 31)
    left = spark.createDataFrame([("1", d1, *[None] * 5), ("1", d2, 1, 1, 1, 1, 1)], schema)
    right = spark.createDataFrame([("1", d1, *[None] * 5), ("1", d3, 1, 1, 1, 1, 1)], schema)
    got = rows(reconcile.reconcile(left, right), "period_end", "coverage", "overall")
    assert got == sorted([(d1, "overlap", "INVALID_COMPARISON"), (d2, "edinet_only", None), (d3, "jquants_only", None)], key=repr)
    summary = reconcile.reconcile_summary(reconcile.reconcile(left, right)).first()
    assert (summary.total, summary.overlap, summary.invalid_comparison) == (3, 1, 1)


RECORD = "ticker string, company_name string, fiscal_year int, period string, period_start date, period_end date, seq bigint, revenue double, operating_income double, net_income double, total_assets double, equity double, operating_cf double, investing_cf double, provisional boolean, statement_type string"


def record(seq, fy, period, end, revenue=1000.0, net=80.0, **kw):
    base = {"total_assets": 5000.0, "equity": 2000.0, "operating_cf": 120.0, "investing_cf": -50.0, **kw}
    return ("1", "Co", fy, period, dt.date(end.year - 1, 4, 1), end, seq, revenue, 100.0, net, base["total_assets"], base["equity"],
            base["operating_cf"], base["investing_cf"], False, None)


def test_dedup_prefers_rich_then_mixed_then_new_then_first(spark):
    end = dt.date(2024, 3, 31)
    df = spark.createDataFrame(
        [record(1, 2024, "duration", end), record(2, 2024, "mixed", end, revenue=None), record(3, 2023, "instant", end), record(4, 2023, "mixed", end),
         record(5, 2022, "FY", end), record(6, 2022, "FY", end), record(7, 2024, "Q1", end)], RECORD)
    kept = records.dedup_records(df)
    assert rows(kept, "fiscal_year", "period_group", "seq") == sorted([(2024, "FY", 1), (2023, "FY", 4), (2022, "FY", 5), (2024, "Q1", 7)], key=repr)
    again = records.dedup_records(kept.drop("period_group"))
    assert rows(again, "seq") == rows(kept, "seq")


def test_annual_and_quarterly_growth(spark):
    d = lambda y: dt.date(y, 3, 31)
    df = spark.createDataFrame(
        [record(1, 2021, "FY", d(2021), 100.0), record(2, 2023, "FY", d(2023), 150.0), record(3, 2021, "Q1", d(2021), 10.0),
         record(4, 2023, "Q1", d(2023), 20.0), record(5, 2024, "Q1", d(2024), 30.0)], RECORD)
    kept = records.dedup_records(df)
    annual = rows(records.annual_series(kept), "fiscal_year", "revenue_growth_yoy_percent", "roe_percent", "free_cash_flow", "period_months")
    assert annual == sorted([(2021, None, 4.0, 70.0, 12), (2023, 50.0, 4.0, 70.0, 12)], key=repr)
    quarterly = rows(records.quarterly_series(kept), "fiscal_year", "revenue_growth_yoy_percent")
    assert quarterly == sorted([(2021, None), (2023, None), (2024, 50.0)], key=repr)


def test_dcf_golden(spark):
    df = spark.createDataFrame(
        [("a", [3.5e9, 3.8e9, 4.2e9, 4.5e9], 5e9, 5e7), ("b", [], 0.0, 1.0), ("c", [-5.0, 10.0], 0.0, None)],
        "ticker string, fcf array<double>, net_debt double, shares double")
    got = {r.ticker: r for r in valuation.dcf(df).collect()}
    assert got["a"].enterprise_value == pytest.approx(102115349771.21, abs=0.02)
    assert got["a"].equity_value == pytest.approx(97115349771.21, abs=0.02)
    assert (got["a"].per_share_value, round(got["a"].estimated_growth_rate, 5)) == (1942.31, 0.08738)
    assert (got["b"].status, got["b"].enterprise_value) == ("empty_series", None)
    assert (got["c"].growth, got["c"].per_share_value) == (0.02, None)
    assert valuation.dcf(df, wacc=0.01).filter("ticker = 'a'").first().status == "wacc_not_above_growth"


def test_multiples_golden(spark):
    cols = ["quoted_market_cap", "market_cap", "net_income", "equity", "operating_income", "depreciation", "ebitda", "total_debt", "cash",
            "series_market_cap", "series_net_income", "series_equity"]
    schema = "ticker string, series_fiscal_year int, " + ", ".join(f"{c} double" for c in cols)
    golden = dict(market_cap=5e10, net_income=4e9, equity=3e10, operating_income=6e9, depreciation=1e9, total_debt=1e10, cash=5e9)
    late = dict(series_market_cap=8.0, series_net_income=2.0, series_equity=4.0)
    mk = lambda t, d: (t, 2025, *[d.get(c) for c in cols])
    got = {r.ticker: r for r in valuation.relative_multiples(spark.createDataFrame([mk("a", golden), mk("b", late)], schema)).collect()}
    assert (got["a"].per, got["a"].pbr, got["a"].ev_ebitda) == (12.5, 1.67, 7.86)
    assert (got["b"].per, got["b"].pbr, got["b"].ev_ebitda, got["b"].net_income_source) == (4.0, 2.0, None, "metrics_series[2025]")


def test_peers_are_first_others(spark):
    df = spark.createDataFrame([(str(i), f"C{i}", "x" if i < 7 else "y", i) for i in range(9)], "ticker string, company_name string, industry string, seq int")
    got = rows(securities.select_peers(df, 3), "ticker", "peer_ticker", "peer_rank")
    want = []
    for t in range(9):
        others = [o for o in range(9) if o != t and (o < 7) == (t < 7)][:3]
        want += [(str(t), str(o), i + 1) for i, o in enumerate(others)]
    assert got == sorted(want, key=repr)


def test_benchmarks_match_statistics(spark):
    import statistics

    data = [3.0, 1.0, 4.0, 1.5, 9.0]
    df = spark.createDataFrame([("t", str(i), i == 0, v, None if i else 2.0, None, v) for i, v in enumerate(data)],
                               "ticker string, member string, is_target boolean, roe double, roa double, operating_margin double, revenue_growth double")
    got = {r.metric: r for r in securities.benchmarks(df).collect()}
    s = sorted(data)
    roe = got["roe"]
    assert (roe.median, roe.mean, roe.std) == (3.0, round(statistics.mean(s), 2), round(statistics.stdev(s), 2))
    assert (roe.q1, roe.q3, roe.target_percentile) == (1.25, 6.5, 60.0)
    assert (got["roa"].median, got["roa"].std) == (2.0, None)
    assert got["operating_margin"].median is None


def test_gaps(spark):
    df = spark.createDataFrame(
        [("1", 3, 2023, None, "b", "c", None, "a"), ("1", 3, 2024, "a", None, "c", None, None), ("1", 3, 2025, None, None, None, None, None)],
        "ticker string, fye_month int, fiscal_year int, q1 string, q2 string, q3 string, h1 string, annual string")
    got = rows(inventory.analyze_gaps(df), "fiscal_year", "quarter", "level")
    assert got == sorted([(2023, "Q1", "acceptable"), (2024, "Q2", "actionable"), (2024, "有報", "actionable"), (2025, "Q1", "acceptable"),
                          (2025, "H1", "actionable"), (2025, "Q3", "acceptable"), (2025, "有報", "acceptable")], key=repr)


def test_latest_manifest_ties(spark):
    df = spark.createDataFrame(
        [("1", "d", "2024-01-02", "b.json", 1), ("1", "d", "2024-01-02", "a.json", 2), ("1", "d", "2024-01-01", "0.json", 3), ("1", None, "2025", "x", 4)],
        "ticker string, doc_id string, fetched_at string, source_file string, seq bigint")
    assert rows(inventory.latest_manifest(df), "seq") == [(2,)]


def test_web_periods(spark):
    df = spark.createDataFrame(
        [("1", "yahoo", 1, "2024-03", True, "100", "10", "5", "5", "1"), ("1", "kabutan", 2, "2024.03", True, None, "12", "6", None, "2.5"),
         ("1", "shikiho", 3, None, True, "200百万円", "---", None, None, None), ("1", "kabutan", 4, "2023.03", False, "9", "9", "9", "9", "9")],
        "ticker string, site string, seq bigint, period string, collected boolean, revenue string, operating_income string, ordinary_income string, net_income string, eps string")
    got = rows(web.harmonize_periods(web.harmonize_rows(df)), "position", "source", "revenue", "operating_income", "ordinary_income", "eps")
    assert got == [(1, "web:yahoo+kabutan", 100.0, 12.0, 6.0, 2.5), (2, "web:shikiho", 2e8, None, None, None)]


def test_risk_table_shows_required(spark):
    df = spark.createDataFrame([("1", "d", 1, "為替の重大な影響がある可能性について述べるこの段落は長い")], "ticker string, document_id string, seq bigint, text string")
    got = {r.category: (r.level, r.items) for r in narrative.risk_level_table(narrative.risk_items(df)).collect()}
    assert got["market_risk"] == ("高", 1) and got["liquidity_risk"] == ("-", 0) and "other_risk" not in got and len(got) == 5


def test_gate_rollup(spark):
    df = spark.createDataFrame([("1", "a", "error", True), ("1", "b", "warn", False), ("2", "a", "error", False)], "ticker string, gate_id string, severity string, pass boolean")
    over = spark.createDataFrame([("2", "a", "warn")], "ticker string, gate_id string, severity string")
    assert rows(quality.gate_rollup(df), "ticker", "overall_pass", "warnings") == [("1", True, "b"), ("2", False, "")]
    assert rows(quality.gate_rollup(df, over), "ticker", "overall_pass", "warnings") == [("1", True, "b"), ("2", True, "a")]


def test_valuation_bounds_override_one_side():
    assert quality.valuation_bounds("value", {"per": (None, 20.0)})["per"] == (0.0, 20.0)


def test_diff_of_itself_is_empty_and_kinds_count(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("m", None, "y")], "key string, a int, b string")
    leaves = changes.flatten_values(df, ["key"], {"a": "s.a", "b": "b"})
    assert changes.snapshot_diff(leaves, leaves, ["key"]).count() == 0
    other = changes.flatten_values(df.withColumn("a", F.col("a").cast("string")), ["key"], {"a": "s.a", "b": "b"})
    got = rows(changes.snapshot_diff(leaves, other, ["key"]), "key", "path", "change")
    assert got == [("k", "s.a", "changed")]


def test_statement_spans(spark):
    texts = {1: "【連結貸借対照表】", **{n: "単位" for n in range(2, 26)}, 30: "【損益計算書】", 31: "千円", 32: "none", 33: "千円",
             34: "【貸借対照表】", 35: "単位", 40: "【キャッシュ・フロー計算書】", **{n: "千円" for n in range(41, 56)}}
    df = spark.createDataFrame([("d", n, texts.get(n, "")) for n in range(1, 60)], "document_id string, page_no int, text string")
    # The second balance sheet is no first heading, so it opens nothing and ends what came before.
    want = [*[(n, "bs", 1) for n in range(1, 26)], (30, "pl", 30), (31, "pl", 30), *[(n, "cf", 40) for n in range(40, 56)]]
    limited = [w for w in want if w[0] < 50]  # a limit concerns the last statement only
    for block in (1000, 7):
        for pages_at_most, expected in ((None, want), (10, limited)):
            found = pages.statement_spans(pages.statement_headers(df), pages_at_most, block_pages=block)
            assert rows(found, "page_no", "statement", "first_page") == sorted(expected, key=repr)


def test_archives_choose_the_public_member_and_report_damage(spark):
    import io
    import zipfile

    ns = 'xmlns="http://www.xbrl.org/2003/instance" xmlns:j="http://x"'
    body = f'<xbrl {ns}><context id="c"><period><endDate>2024-03-31</endDate><startDate>2023-04-01</startDate></period></context>'
    body += '<j:NetSales contextRef="c" sign="-">5</j:NetSales><j:NetSales contextRef="gone">6</j:NetSales>'
    body += '<j:BusinessRisksTextBlock contextRef="c"> &lt;p&gt;risk&lt;/p&gt; </j:BusinessRisksTextBlock></xbrl>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("a.xbrl", f"<xbrl {ns}/>")
        archive.writestr("XBRL/PublicDoc/long-name.xbrl", body)
    df = spark.createDataFrame(
        [("/x/D1.zip", bytearray(buffer.getvalue()), 999), ("/x/D2.zip", bytearray(b""), 0), ("/x/D3.pdf", bytearray(b"\n <HTML>"), 8), ("/x/D4.pdf", bytearray(b"%PDF"), 4)],
        "path string, content binary, length bigint")
    facts_read = rows(filing_archives.xbrl_facts(df.filter("path like '%.zip'")), "document_id", "concept", "text", "sign", "period_type", "error")
    assert [r for r in facts_read if r[1] == "NetSales"] == [("D1", "NetSales", "5", "-", "duration", None)]
    assert [r for r in facts_read if r[5]] == [("D2", None, None, None, "unknown", "BadZipFile")]
    assert rows(readers.corrupt_files(df), "path") == [("/x/D2.zip",), ("/x/D3.pdf",)]


def test_source_fallback_reuses_the_backup(spark):
    df = spark.createDataFrame(
        [("1", "shikiho", "s", False, "E1", None), ("1", "yahoo", "y", True, None, "7"), ("2", "shikiho", "s", True, None, "3"), ("3", "shikiho", "s", False, "E2", None)],
        "ticker string, site string, url string, collected boolean, error string, per_text string")
    got = rows(web.source_fallback(df), "ticker", "url", "collected", "per_text", "error", "fallback_reason")
    assert got == sorted([("1", "y", True, "7", None, "E1"), ("2", "s", True, "3", None, None), ("3", "s", False, None, "E2", None)], key=repr)


def test_running_values_over_measured_ranges(spark):
    """Sparse, dense, repeated and missing order values; a group that holds most rows is spread over many ranges."""
    import random

    from ledgerloom.operators import ranking

    rng = random.Random(2)
    rows = [("hot", i * (1 if i < 3000 else 10**9), i % 13) for i in range(4000)] + [(None, None, 5), (None, 3, 1), ("b", 2, 7), ("b", 1, 8)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    held = []
    store = lambda d: held.append(ranking.landed(d)) or held[-1]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    out = ranking.running(
        df, ["k"], [F.col("o").asc_nulls_first()], position="no", sums={"total": F.col("v")}, folds={"fold": F.col("v")}, store=store
    )
    spark.conf.unset(merge)
    got = {(r.k, r.o): (r.no, r.total, r.fold) for r in out.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        total = fold = 0
        its = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
        for no, (_, o, v) in enumerate(its, 1):
            total, fold = total + v, fold ^ v
            want[key, o] = (no, total, fold)
    assert got == want
    sizes = [r["count"] for r in held[0].where("k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_type_maps_over_odd_records(spark):
    records = ['{"revenue": "1", "cf": {"operating_cf": true}, "pl": {"revenue": 2}}', '{"ticker": 5, "sources": [], "metadata": null}', "[1]", "7", None, "{}"]
    rows = spark.createDataFrame(list(enumerate(records)), "seq int, j string").select("seq", F.try_parse_json("j").alias("record"))
    maps = {"one": {"revenue": "number", "operating_cf": "number"}, "two": {"ticker": "text", "sources": "object", "metadata": "object"}}
    got = sorted(tuple(r) for r in quality.type_mismatches(rows, ["seq"], "record", maps).collect())
    # The statement's own figure is preferred to the one at the top level.
    assert got == [(0, "one", "operating_cf", "number", "boolean"), (1, "two", "sources", "object", "array"), (1, "two", "ticker", "text", "number")]


def test_continued_statement_is_judged_by_its_head(spark):
    rows = [("d", 1, "【貸借対照表】"), ("d", 2, "x\n（単位：千円）\n1"), ("d", 3, "a\nb\nc\n単位"), ("d", 4, "千円")]
    headers = pages.statement_headers(spark.createDataFrame(rows, "document_id string, page_no int, text string"))
    assert sorted(r.page_no for r in pages.statement_spans(headers).collect()) == [1, 2]


def test_structured_figures_are_hashed_not_sorted(spark):
    fields = "ticker string, doc_id string, doc_type_code string, period_end string, section string, table_no int, record_no int, item string, header string, column_index int, seq long, parsed double"
    row = lambda item, column, seq, value, record=0, doc="d": ("1", doc, "120", "p", "income_statement", 0, record, item, "（円）", column, seq, value)
    cells = [row("売上高", 0, 1, 1.0), row("売上高", 1, 5, 2.0), row("売上高", 1, 4, 3.0), row("営業利益", 2, 9, None), row("営業利益", 1, 8, 4.0), row("営業利益", 0, 3, 7.0, 1)]
    out = reconcile.structured_figures(spark.createDataFrame([*cells, row("その他", 0, 2**40, 5.0, doc="other")], fields))
    got = {r.doc_id: (r.revenue, r.operating_income, r.equity) for r in out.collect()}
    # A record whose last column holds nothing has no figure; a document without a wanted record stays.
    assert got == {"d": (3.0, 7.0, None), "other": (None, None, None)}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_facts_of_unknown_concepts_and_documents_of_a_period(spark):
    sources = [("1", "A", "c", 1, "Net Sales", "1,000", "-"), ("1", "B", "c", 2, "jp:Unknown", "5", None), ("1", "B", "c", 3, "netsales", "-", None), ("1", "B", "c", 4, "NetSales", "7", None), ("1", "B", "c", 5, None, "7", None)]
    found = spark.createDataFrame(sources, "ticker string, document_id string, context_id string, seq long, concept string, text string, sign string")
    assert sorted((r.document_id, r.seq, r.concept, r.value) for r in facts.numeric_facts(found).collect() if r.value is not None) == [("A", 1, "revenue", -1000.0), ("B", 4, "revenue", 7.0)]
    contexts = spark.createDataFrame([(d, "c", "duration", None, dt.date(2024, 3, 31)) for d in "AB"], "document_id string, context_id string, period_type string, start_date date, period_end date")
    rows = facts.derive_totals(facts.period_rows(found, contexts))
    assert sorted(r.document_id for r in facts.period_documents(rows).collect()) == ["A", "B"]
    assert facts.period_index(rows).first().revenue == -1000.0


def test_period_index_names_its_documents(spark):
    sources = [("1", d, "c", i, "NetSales", "7", None) for i, d in enumerate("BAC")]
    found = spark.createDataFrame(sources, "ticker string, document_id string, context_id string, seq long, concept string, text string, sign string")
    contexts = spark.createDataFrame([(d, "c", "duration", None, dt.date(2024, 3, 31)) for d in "ABC"], "document_id string, context_id string, period_type string, start_date date, period_end date")
    index = facts.period_index(facts.derive_totals(facts.period_rows(found, contexts)))
    assert [r.source_document_ids for r in index.collect()] == [["A", "B", "C"]]


def test_type_maps_put_no_filter_below_the_array_of_wrong_fields(spark):
    rows = spark.createDataFrame([(1, '{"a": "x"}')], "seq int, j string").select("seq", F.parse_json("j").alias("record"))
    found = quality.type_mismatches(rows, ["seq"], "record", {"m": {"a": "number", "b": "text"}, "n": {"a": "array"}})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == len(quality.LEVELS) and "element_at(levels" not in plan
    assert sorted(tuple(r) for r in found.collect()) == [(1, "m", "a", "number", "text"), (1, "n", "a", "array", "text")]


def test_figures_are_resolved_by_one_aggregation_with_priority_before_place(spark):
    fields = "ticker string, document_id string, period_end string, concept string, priority int, seq long, value double"
    rows = [("1", "d", "p", "c", 60, 9_000_000_000_000_000_000, 1.0), ("1", "d", "p", "c", 100, 5, 2.0), ("1", "d", "p", "c", 100, 7, 3.0), ("1", "d", "p", "x", -80, 1, 4.0), ("1", "d", "p", "x", -65, 0, 5.0)]
    out = facts._resolved(spark.createDataFrame(rows, fields).repartition("document_id", "period_end"))
    assert sorted((r.concept, r.value, r.priority) for r in out.collect()) == [("c", 3.0, 100), ("x", 5.0, -65)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_leaves_are_dealt_out_before_they_are_sorted(spark):
    old, new = [("1", 1, "a", "1", "int"), ("1", 2, "a", "2", "int"), (None, None, "b", "3", "int")], [("1", 1, "a", "4", "int"), (None, None, "b", "3", "int"), ("1", 3, "a", "5", "int")]
    frame = lambda r: spark.createDataFrame(r, "ticker string, seq int, path string, value string, kind string")
    out = changes.snapshot_diff(frame(old), frame(new), ["ticker", "seq"])
    assert sorted((r.seq, r.change) for r in out.collect()) == [(1, "changed"), (2, "removed"), (3, "added")]
    assert "RebalancePartitions" in out._jdf.queryExecution().optimizedPlan().toString()

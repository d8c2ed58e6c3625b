"""Queries: security master, filings, inventory and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_double, s_filing, s_fy, s_strip
from ledgerloom.functions.dates import fiscal_year
from ledgerloom.operators import inventory as I
from ledgerloom.operators import reconcile as R
from ledgerloom.operators import securities as S
from ledgerloom.rules.concepts import COMPARE_FIELDS

# ------------------------------------------------------------------ security master

S_MASTER = r"""fil AS (SELECT * FROM b_securities WHERE trim(listing) NOT IN ('', '非上場')),
lis AS (SELECT DISTINCT cast(1000 + s_suppkey AS VARCHAR) || '0' AS code, s_name || ' Inc' AS company_name FROM supplier WHERE s_suppkey % 4 <> 2),
master AS (SELECT coalesce(f.sec_code, l.code) AS sec_code, coalesce(f.edinet_code, '') AS edinet_code,
   CASE WHEN f.sec_code IS NOT NULL THEN f.company_name ELSE l.company_name END AS company_name,
   coalesce(TRY_CAST(regexp_extract(f.fye_text, '([0-9]{1,2})月', 1) AS INTEGER), TRY_CAST(regexp_extract(f.fye_text, '([0-9]{1,2})/[0-9]{1,2}', 1) AS INTEGER)) AS fye_month
   FROM fil f FULL OUTER JOIN lis l ON f.sec_code = l.code)"""
MDEPS = ["b_securities"]


def master(t):
    filers = t.b_securities.withColumn("seq", F.col("suppkey"))
    c = F.col
    listed = t.supplier.filter(c("s_suppkey") % 4 != 2).select(
        F.concat((c("s_suppkey") + 1000).cast("string"), F.lit("0")).alias("code"),
        F.concat(c("s_name"), F.lit(" Inc")).alias("company_name"), c("s_suppkey").alias("seq"),
    )
    return S.security_master(filers, listed)


@query("j1_security_master", MDEPS, f"WITH {S_MASTER} SELECT * FROM master")
def j1(t):
    return master(t)


@query("j2_resolve", MDEPS + ["b_text"], f"""WITH {S_MASTER}
SELECT x.ticker, m.edinet_code, m.company_name, m.fye_month, m.sec_code IS NOT NULL AS found FROM (SELECT DISTINCT ticker FROM b_text) x
LEFT JOIN master m ON m.sec_code = x.ticker || '0'""")
def j2(t):
    return S.resolve_tickers(t.b_text.select("ticker").distinct(), master(t))


@query("j2_reverse_resolve", MDEPS + ["b_filings"], f"""WITH {S_MASTER}
SELECT x.edinetCode AS edinet_code, m.company_name, m.sec_code, left(m.sec_code, 4) AS ticker, m.fye_month, m.sec_code IS NOT NULL AS found
FROM (SELECT DISTINCT edinetCode FROM b_filings) x LEFT JOIN master m ON m.edinet_code = x.edinetCode AND m.edinet_code <> ''""")
def j2_reverse(t):
    return S.resolve_edinet_codes(t.b_filings.select(F.col("edinetCode").alias("edinet_code")).distinct(), master(t))


@query("p5_list_securities", MDEPS, f"WITH {S_MASTER} SELECT edinet_code, company_name, sec_code, left(sec_code, 4) AS ticker, fye_month FROM master WHERE fye_month = 6")
def p5(t):
    return S.search_securities(master(t), month=6)


@query("p5_name_search", MDEPS, f"WITH {S_MASTER} SELECT edinet_code, company_name, sec_code, left(sec_code, 4) AS ticker, fye_month FROM master WHERE contains(lower(company_name), '7 inc')")
def p5_name(t):
    return S.search_securities(master(t), name_part="7 Inc")


@query("j14_homepage_url", MDEPS + ["b_text"], f"""WITH {S_MASTER}
SELECT x.ticker, s.hp AS homepage FROM (SELECT DISTINCT ticker FROM b_text) x JOIN master m ON m.sec_code = x.ticker || '0' JOIN b_securities s ON s.edinet_code = m.edinet_code
WHERE m.edinet_code <> '' AND s.hp IS NOT NULL""")
def j14(t):
    from ledgerloom.operators.web import homepage_urls

    return homepage_urls(t.b_text.select("ticker").distinct(), master(t), t.b_securities)


@query("p8_stale_snapshot", ["b_securities"], """
SELECT ticker, last, date_diff('day', last, DATE '2001-08-31') >= 30 AS expired FROM (
  SELECT CAST(CAST(floor(1000 + o_custkey / 15) AS BIGINT) AS VARCHAR) AS ticker, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1)""")
def p8(t):
    from ledgerloom.operators.web import is_stale

    last = t.orders.groupBy(F.floor(F.col("o_custkey") / 15 + 1000).cast("string").alias("ticker")).agg(
        F.max("o_orderdate").cast("date").alias("last")
    )
    return last.select("ticker", "last", is_stale(F.col("last"), F.lit("2001-08-31").cast("date")).alias("expired"))


# ------------------------------------------------------------------ filings and manifests

@query("p1_target_filings", ["b_filings"], r"""
SELECT docID, edinetCode, formCode FROM b_filings WHERE contains(docDescription, '半期報告書') AND regexp_matches(docID, '^[A-Za-z0-9_\-]+$')
AND trim(formCode) IN ('030000', '043000') AND trim(docTypeCode) IN ('140', '160') AND xbrlFlag = '1'""")
def p1(t):
    return I.target_filings(
        t.b_filings, "半期報告書", form_codes=["030000", "043000"], doc_types=["140", "160"]
    ).select("docID", "edinetCode", "formCode")


S_LATEST = """lm AS (SELECT * FROM b_manifests QUALIFY row_number() OVER (PARTITION BY ticker, doc_id ORDER BY fetched_at DESC, source_file, seq) = 1)"""


@query("a9_latest_manifest", ["b_manifests"], f"WITH {S_LATEST} SELECT * FROM lm")
def a9(t):
    return I.latest_manifest(t.b_manifests)


@query("j4_current_period", ["b_edinet"], """
SELECT ticker, document_id, period_end, period_start, seq FROM b_edinet WHERE period_start IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY period_end DESC, seq) = 1""")
def j4(t):
    return I.current_period(t.b_edinet).select("ticker", "document_id", "period_end", "period_start", "seq")


S_DOCS = S_LATEST + f""",
man AS (SELECT *, TRY_CAST(left(period_end, 10) AS DATE) AS me FROM lm WHERE TRY_CAST(left(period_end, 10) AS DATE) IS NOT NULL),
cur AS (SELECT m.ticker, m.doc_id, p.period_end AS pe, p.period_start AS ps, p.company_name FROM man m JOIN b_edinet p ON p.ticker = m.ticker AND p.document_id = m.doc_id
   WHERE p.period_start IS NOT NULL QUALIFY row_number() OVER (PARTITION BY m.doc_id ORDER BY (p.period_end = m.me) DESC, p.period_end DESC, p.seq) = 1),
docs0 AS (SELECT m.ticker, m.doc_id, s.fye_month, coalesce(c.pe, m.me) AS period_end, c.ps AS period_start, c.company_name, m.source_file, m.fetched_at, m.seq
   FROM man m LEFT JOIN cur c ON c.doc_id = m.doc_id JOIN b_securities s ON s.ticker = m.ticker),
docs AS (SELECT *, {s_filing('period_end', 'period_start', 'fye_month')} AS period_type, {s_fy('period_end', 'fye_month')} AS fiscal_year FROM docs0)"""
DDEPS = ["b_manifests", "b_edinet", "b_securities"]


def documents(t):
    return I.manifest_documents(t.b_manifests, t.b_edinet, t.b_securities)


@query("j3_manifest_documents", DDEPS, f"WITH {S_DOCS} SELECT * FROM docs")
def j3(t):
    return documents(t)


S_MATRIX = S_DOCS + """,
cells AS (SELECT ticker, fye_month, fiscal_year, period_type, doc_id FROM docs WHERE period_type IN ('q1','q2','q3','h1','annual')
   QUALIFY row_number() OVER (PARTITION BY ticker, fiscal_year, period_type ORDER BY period_end, seq) = 1),
mat AS (SELECT ticker, fye_month, fiscal_year, max(doc_id) FILTER (WHERE period_type = 'q1') AS q1, max(doc_id) FILTER (WHERE period_type = 'q2') AS q2,
   max(doc_id) FILTER (WHERE period_type = 'q3') AS q3, max(doc_id) FILTER (WHERE period_type = 'h1') AS h1, max(doc_id) FILTER (WHERE period_type = 'annual') AS annual FROM cells GROUP BY ALL)"""


def statement_rows(t):
    return t.b_raw_statements.join(t.b_securities.select("ticker", "fye_month"), "ticker").withColumn(
        "fy_end", F.col("CurrentFiscalYearEndDate").try_cast("date")
    )


@query("a13_inventory_matrix", DDEPS + ["b_raw_statements"], f"""WITH {S_MATRIX},
st AS (SELECT r.ticker, s.fye_month, {s_fy('CAST(CurrentFiscalYearEndDate AS DATE)', 's.fye_month')} AS fiscal_year,
    count(*) AS statements FROM b_raw_statements r JOIN b_securities s ON s.ticker = r.ticker GROUP BY ALL)
SELECT * FROM mat FULL OUTER JOIN st USING (ticker, fye_month, fiscal_year)""")
def a13(t):
    return I.inventory_matrix(documents(t), statement_rows(t))


@query("a13_statement_labels", ["b_raw_statements", "b_securities"], f"""
SELECT *, row_number() OVER (PARTITION BY ticker, fiscal_year ORDER BY seq) AS position FROM (SELECT r.ticker, {s_fy('CAST(CurrentFiscalYearEndDate AS DATE)', 's.fye_month')} AS fiscal_year, seq,
  TypeOfCurrentPeriod || ' ' || DisclosedDate AS label FROM b_raw_statements r JOIN b_securities s ON s.ticker = r.ticker)""")
def a13_labels(t):
    return I.statement_labels(statement_rows(t))


@query("a14_gap_analysis", DDEPS, f"""WITH {S_MATRIX},
y AS (SELECT *, min(fiscal_year) OVER (PARTITION BY ticker) AS f, max(fiscal_year) OVER (PARTITION BY ticker) AS l FROM mat),
e AS (SELECT y.*, q.q, q.o, CAST(CASE WHEN fye_month = 12 THEN make_date(fiscal_year, 1, 1) ELSE make_date(fiscal_year - 1, fye_month + 1, 1) END + to_months(q.o) AS DATE) AS qs,
   CASE q.q WHEN 'q1' THEN q1 WHEN 'q2' THEN q2 WHEN 'q3' THEN q3 ELSE annual END AS have FROM y, (VALUES ('q1', 0), ('q2', 3), ('q3', 6), ('annual', 0)) q(q, o))
SELECT ticker, fiscal_year, CASE WHEN q = 'annual' THEN '有報' WHEN q = 'q2' AND qs >= DATE '2024-04-01' THEN 'H1' ELSE upper(q) END AS quarter,
  CASE WHEN q = 'annual' THEN CASE WHEN fiscal_year IN (l, f) THEN 'acceptable' ELSE 'actionable' END
       WHEN qs >= DATE '2024-04-01' THEN CASE WHEN q = 'q2' THEN 'actionable' ELSE 'acceptable' END WHEN fiscal_year = f THEN 'acceptable' ELSE 'actionable' END AS level,
  CASE WHEN q = 'annual' THEN CASE WHEN fiscal_year = l THEN '最新年度 (未発表の可能性)' WHEN fiscal_year = f THEN '収集対象期間の開始年度' ELSE '存在すべきだが欠損' END
       WHEN qs >= DATE '2024-04-01' THEN CASE WHEN q = 'q2' THEN '半期報告書が未収集' ELSE '四半期報告書制度廃止 (2024年4月施行)' END
       WHEN fiscal_year = f THEN '収集対象期間の開始年度' ELSE '存在すべきだが欠損' END AS reason
FROM e WHERE have IS NULL AND NOT (q = 'q2' AND qs >= DATE '2024-04-01' AND h1 IS NOT NULL)""")
def a14(t):
    return I.analyze_gaps(I.inventory_matrix(documents(t)))


@query("w7_first_last_year", DDEPS, f"WITH {S_DOCS} SELECT ticker, min(fiscal_year) AS first_fy, max(fiscal_year) AS last_fy FROM docs GROUP BY ticker")
def w7(t):
    return documents(t).groupBy("ticker").agg(F.min("fiscal_year").alias("first_fy"), F.max("fiscal_year").alias("last_fy"))


_QM = ", ".join(f"('{m}', {m} IS NOT NULL)" for m in I.QUALITY_METRICS)


@query("a15_quality_summary", ["b_edinet"], f"""
WITH c AS (SELECT * FROM b_edinet WHERE period_start IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY period_end DESC, seq) = 1),
l AS (SELECT c.ticker, m.metric, m.known FROM c, LATERAL (VALUES {_QM}) m(metric, known))
SELECT ticker, metric, count(*) AS total, count(*) FILTER (WHERE known) AS known, count(*) FILTER (WHERE known)::DOUBLE / count(*) AS ratio FROM l GROUP BY ALL""")
def a15(t):
    return I.quality_summary(t.b_edinet)


@query("a16_doc_type_counts", DDEPS, f"WITH {S_DOCS} SELECT ticker, period_type, count(*) AS documents, count(DISTINCT fiscal_year) AS fiscal_years FROM docs GROUP BY ALL")
def a16(t):
    return I.doc_type_counts(documents(t))


@query("w5_file_numbering", DDEPS, f"WITH {S_DOCS} SELECT ticker, doc_id, row_number() OVER (PARTITION BY ticker ORDER BY period_end, seq) AS number FROM docs")
def w5(t):
    return I.number_documents(documents(t)).select("ticker", "doc_id", "number")


@query("a21_collection_stats", ["b_manifests"], """
WITH c AS (SELECT ticker, count(*) AS attempted, count(*) FILTER (WHERE status = 'downloaded') AS downloaded, count(*) FILTER (WHERE status = 'skipped_existing') AS skipped_existing,
  count(*) FILTER (WHERE status = 'failed') AS failed, CAST(date_diff('day', min(list_date), max(list_date)) + 1 AS INTEGER) AS calendar_days FROM b_manifests GROUP BY ticker)
SELECT *, round_even(downloaded / attempted * 1e4, 0) / 1e4 AS coverage_ratio, round_even((downloaded + skipped_existing) / attempted * 1e4, 0) / 1e4 AS effective_coverage_ratio FROM c""")
def a21(t):
    return I.collection_stats(t.b_manifests)


@query("a33_shares_outstanding", ["b_raw_statements"], f"""
WITH l AS (SELECT ticker, {s_double('issued')} AS i, coalesce({s_double('treasury')}, 0e0) AS tr FROM b_raw_statements QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq DESC) = 1)
SELECT ticker, coalesce(CAST(CAST(CASE WHEN i - tr > 0 THEN i - tr ELSE i END AS BIGINT) AS VARCHAR), '') AS shares FROM l""")
def a33(t):
    return I.shares_outstanding(t.b_raw_statements)


@query("j13_company_name_lookup", ["b_records", "b_filings", "b_securities"], """
WITH parsed AS (SELECT ticker, arg_min(n, o) AS n FROM (SELECT ticker, CASE WHEN suppkey % 4 = 0 THEN 'Unknown' WHEN suppkey % 4 = 1 THEN ' ' ELSE company_name END AS n, (seq, source) AS o FROM b_records)
   WHERE trim(n) NOT IN ('', 'Unknown') GROUP BY ticker),
filed AS (SELECT secCode, arg_max(filerName, (list_date, -seq)) AS n FROM b_filings WHERE trim(filerName) <> '' GROUP BY secCode)
SELECT s.ticker, coalesce(trim(p.n), trim(f.n)) AS company_name FROM b_securities s LEFT JOIN parsed p ON p.ticker = s.ticker LEFT JOIN filed f ON f.secCode = s.ticker || '0'""")
def j13(t):
    from ledgerloom.operators.web import company_name_lookup

    c = F.col
    parsed = t.b_records.select(
        "ticker", F.when(c("suppkey") % 4 == 0, "Unknown").when(c("suppkey") % 4 == 1, " ").otherwise(c("company_name")).alias("company_name"),
        F.struct("seq", "source").alias("place"),
    )
    filings = t.b_filings.select(
        c("secCode").alias("sec_code"), c("filerName").alias("filer_name"), F.struct("list_date", (-c("seq")).alias("s")).alias("place")
    )
    return company_name_lookup(t.b_securities.select("ticker"), parsed, filings)


# ------------------------------------------------------------------ reconciliation

_COUNT = " + ".join(f"({f} IS NOT NULL)::INT" for f in COMPARE_FIELDS)
_V = lambda f: (
    f"CASE WHEN e.ticker IS NULL OR j.ticker IS NULL THEN NULL WHEN e.{f} IS NULL AND j.{f} IS NULL THEN 'BOTH_NULL' WHEN e.{f} IS NULL THEN 'EDINET_NULL' "
    f"WHEN j.{f} IS NULL THEN 'JQUANTS_NULL' WHEN e.{f} = 0 AND j.{f} = 0 THEN 'MATCH' WHEN j.{f} = 0 THEN 'MISMATCH' "
    f"WHEN abs(e.{f}::DOUBLE - j.{f}::DOUBLE) / abs(j.{f}::DOUBLE) <= 1e-4 THEN 'MATCH' ELSE 'MISMATCH' END AS {f}_match, "
    f"CASE WHEN e.ticker IS NULL OR j.ticker IS NULL THEN NULL WHEN e.{f} = 0 AND j.{f} = 0 THEN 0e0 WHEN j.{f} <> 0 THEN round_even(abs(e.{f}::DOUBLE - j.{f}::DOUBLE) / abs(j.{f}::DOUBLE) * 1e6, 0) / 1e6 END AS {f}_diff"
)
_ANY = " OR ".join(f"{f}_match = 'MISMATCH'" for f in COMPARE_FIELDS)
_ALLNULL = " AND ".join(f"{f}_match = 'BOTH_NULL'" for f in COMPARE_FIELDS)
S_REC = f"""e AS (SELECT ticker, period_end, seq, document_id, {', '.join('total_equity AS equity' if f == 'equity' else f for f in COMPARE_FIELDS)} FROM b_edinet
   QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY {_COUNT.replace('(equity', '(total_equity')} DESC, seq) = 1),
j AS (SELECT * FROM b_statements WHERE coalesce({', '.join(COMPARE_FIELDS)}) IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY {_COUNT} DESC, seq) = 1),
v AS (SELECT coalesce(e.ticker, j.ticker) AS ticker, coalesce(e.period_end, j.period_end) AS period_end,
   CASE WHEN e.ticker IS NULL THEN 'jquants_only' WHEN j.ticker IS NULL THEN 'edinet_only' ELSE 'overlap' END AS coverage, {', '.join(_V(f) for f in COMPARE_FIELDS)}
   FROM e FULL OUTER JOIN j ON e.ticker = j.ticker AND e.period_end = j.period_end),
rec AS (SELECT *, CASE WHEN coverage = 'overlap' THEN CASE WHEN {_ALLNULL} THEN 'INVALID_COMPARISON' WHEN {_ANY} THEN 'MISMATCH' ELSE 'MATCH' END END AS overall FROM v)"""
RDEPS = ["b_edinet", "b_statements"]


def reconciled(t):
    filings = R.richest_entry(t.b_edinet.withColumnRenamed("total_equity", "equity"), ["document_id"])
    statements = R.richest_entry(R.drop_all_null(t.b_statements), ["type_of_current_period"])
    return R.reconcile(filings, statements)


@query("p3_all_null_drop", ["b_statements"], f"SELECT ticker, seq FROM b_statements WHERE coalesce({', '.join(COMPARE_FIELDS)}) IS NOT NULL")
def p3(t):
    return R.drop_all_null(t.b_statements).select("ticker", "seq")


@query("a8_richest_entry", ["b_statements"], f"""
SELECT ticker, period_end, type_of_current_period, {', '.join(COMPARE_FIELDS)} FROM b_statements WHERE coalesce({', '.join(COMPARE_FIELDS)}) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY {_COUNT} DESC, seq) = 1""")
def a8(t):
    return R.richest_entry(R.drop_all_null(t.b_statements), ["type_of_current_period"])


@query("j7_reconcile", RDEPS, f"WITH {S_REC} SELECT * FROM rec")
def j7(t):
    flat = [c for f in COMPARE_FIELDS for c in (F.col(f"{f}.match").alias(f"{f}_match"), F.col(f"{f}.diff_pct").alias(f"{f}_diff"))]
    return reconciled(t).select("ticker", "period_end", "coverage", *flat, "overall")


@query("a34_reconcile_summary", RDEPS, f"""WITH {S_REC} SELECT ticker, count(*) AS total, count(*) FILTER (WHERE coverage = 'overlap') AS overlap,
 count(*) FILTER (WHERE coverage = 'edinet_only') AS edinet_only, count(*) FILTER (WHERE coverage = 'jquants_only') AS jquants_only, count(*) FILTER (WHERE overall = 'MATCH') AS match,
 count(*) FILTER (WHERE overall = 'MISMATCH') AS mismatch, count(*) FILTER (WHERE overall = 'INVALID_COMPARISON') AS invalid_comparison FROM rec GROUP BY ticker""")
def a34(t):
    return R.reconcile_summary(reconciled(t))


@query("j9_absence_flags", ["b_edinet", "b_records"], f"""
WITH m AS (SELECT DISTINCT ticker, {s_fy('period_end', 'fye_month')} AS fiscal_year FROM b_edinet),
a AS (SELECT ticker, fye_month, period_end, CASE WHEN seq % 2 = 0 THEN 'revenue' ELSE 'net_income' END AS field, 'gone ' || period_end AS reason FROM b_records WHERE source = 'jquants' AND revenue IS NULL)
SELECT m.ticker, m.fiscal_year, a.field, a.reason FROM m JOIN a ON a.ticker = m.ticker AND
   ((fye_month = 12 AND year(a.period_end) = m.fiscal_year) OR (fye_month <> 12 AND ((year(a.period_end) = m.fiscal_year AND month(a.period_end) <= fye_month)
     OR (year(a.period_end) = m.fiscal_year - 1 AND month(a.period_end) > fye_month))))
QUALIFY row_number() OVER (PARTITION BY m.ticker, m.fiscal_year, a.field ORDER BY a.period_end DESC) = 1""")
def j9(t):
    c = F.col
    metrics = t.b_edinet.select("ticker", fiscal_year(c("period_end"), c("fye_month")).alias("fiscal_year")).distinct()
    absences = t.b_records.filter((c("source") == "jquants") & c("revenue").isNull()).select(
        "ticker", "fye_month", "period_end", F.when(c("seq") % 2 == 0, "revenue").otherwise("net_income").alias("field"),
        F.concat(F.lit("gone "), c("period_end").cast("string")).alias("reason"),
    )
    return R.absence_flags(metrics, absences)


@query("a30_fye_inference", ["b_statements"], """
SELECT ticker, CAST(coalesce(month(min(CASE WHEN type_of_current_period = 'FY' AND suppkey % 3 <> 1 THEN period_end END)), 12) AS INTEGER) AS fye_month FROM b_statements GROUP BY ticker""")
def a30(t):
    kind = F.when(F.col("suppkey") % 3 != 1, F.col("type_of_current_period"))
    return R.infer_fye_month(t.b_statements.withColumn("type_of_current_period", kind))


@query("s11_structured_tables", ["b_cells"], """
WITH cur AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section, table_no, record_no, item, header ORDER BY column_index DESC, seq) AS rn FROM b_cells),
x AS (SELECT *, parsed * CASE WHEN contains(header, '百万円') THEN 1000000 WHEN contains(header, '千円') THEN 1000 WHEN contains(header, '（円）') THEN 1 ELSE 1000 END AS amount FROM cur WHERE rn = 1 AND parsed IS NOT NULL),
f AS (SELECT *, CASE WHEN section = 'income_statement' AND item IN ('売上高','営業収益') THEN 'revenue' WHEN section = 'income_statement' AND item IN ('営業利益','営業利益又は営業損失（△）') THEN 'operating_income'
   WHEN section = 'income_statement' AND contains(item, '親会社株主に帰属する') THEN 'net_income' WHEN section = 'balance_sheet' AND item = '資産合計' THEN 'total_assets'
   WHEN section = 'balance_sheet' AND item = '純資産合計' THEN 'equity' END AS field FROM x),
b AS (SELECT * FROM f WHERE field IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, field ORDER BY table_no, record_no, amount) = 1),
d AS (SELECT DISTINCT ticker, doc_id, doc_type_code, period_end FROM x)
SELECT d.*, r.amount AS revenue, o.amount AS operating_income, n.amount AS net_income, a.amount AS total_assets, q.amount AS equity FROM d
LEFT JOIN b r ON r.doc_id = d.doc_id AND r.field = 'revenue' LEFT JOIN b o ON o.doc_id = d.doc_id AND o.field = 'operating_income'
LEFT JOIN b n ON n.doc_id = d.doc_id AND n.field = 'net_income' LEFT JOIN b a ON a.doc_id = d.doc_id AND a.field = 'total_assets' LEFT JOIN b q ON q.doc_id = d.doc_id AND q.field = 'equity'""")
def s11(t):
    return R.structured_figures(t.b_cells)

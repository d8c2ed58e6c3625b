"""Queries of readers, sinks and streams: the tables are landed as files and read back."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_strip
from ledgerloom.sources import readers as R
from ledgerloom.sources import sinks, xbrl
from ledgerloom.sources.landing import shared_folder
from ledgerloom.streaming import jobs


def land_filings(t) -> str:
    """Filing lists by day, in payloads of at most a thousand filings, with a damaged line per file."""
    names = ["docID", "edinetCode", "secCode", "docTypeCode", "formCode", "docDescription", "xbrlFlag", "filerName"]
    payloads = t.b_filings.groupBy("list_date", F.floor(F.col("seq") / 1000).alias("chunk")).agg(
        F.collect_list(F.struct(*names)).alias("results")
    )
    line = F.to_json(F.struct(F.col("list_date").cast("string").alias("date"), F.size("results").alias("result_count"), "results"))
    folder = shared_folder(t.spark, "filings")
    good = payloads.select(line.alias("value"))
    damaged = t.b_filings.filter(F.col("seq") % 500 == 0).select(F.concat(F.lit('{"date": "'), "docID").alias("value"))
    good.unionByName(damaged).write.text(folder)
    return folder


_FILING_COLS = "docID, edinetCode, secCode, docTypeCode, formCode, docDescription, xbrlFlag, filerName, list_date"


@query("s1_filing_index", ["b_filings"], f"SELECT {_FILING_COLS} FROM b_filings")
def s1(t):
    return R.read_filing_index(t.spark, land_filings(t)).select(*_FILING_COLS.split(", "))


@query("s1_filing_index_errors", ["b_filings"], """SELECT '{"date": "' || docID AS payload FROM b_filings WHERE seq % 500 = 0""")
def s1_errors(t):
    return R.filing_index_errors(t.spark, land_filings(t)).select("payload")


MANIFEST_ROWS = 10_000
# Rows by the manifest that holds them and their place in it.
S_PLACED = f"""placed AS (SELECT ticker, source_file || '.' || (seq // {MANIFEST_ROWS}) AS source_file, fetched_at, doc_id, status, period_end,
  row_number() OVER (PARTITION BY ticker, source_file, fetched_at, seq // {MANIFEST_ROWS} ORDER BY seq) - 1 AS seq FROM b_manifests)"""


def manifest_name(path: str):
    """The folder that a manifest was found in."""
    return F.regexp_extract(F.col(path), "/manifest=([^/]+)/", 1)


def land_manifests(t) -> str:
    """Manifests in folders of their name, as landed by collectors, in pieces of bounded size, with a damaged line in some."""
    chunk = F.floor(F.col("seq") / MANIFEST_ROWS)
    results = F.sort_array(F.collect_list(F.struct("seq", "doc_id", "status", "period_end")))
    payloads = t.b_manifests.groupBy("ticker", "source_file", "fetched_at", chunk.alias("chunk")).agg(results.alias("results"))
    line = F.to_json(F.struct("ticker", "fetched_at", F.transform("results", lambda r: r.dropFields("seq")).alias("results")))
    name = lambda c: F.concat("source_file", F.lit("."), c.cast("string")).alias("manifest")
    good = payloads.select(line.alias("value"), name(F.col("chunk")))
    damaged = t.b_manifests.filter(F.col("seq") % 5000 == 0).select(F.concat(F.lit('{"ticker": "'), "doc_id").alias("value"), name(chunk))
    folder = shared_folder(t.spark, "manifests")
    good.unionByName(damaged).repartition("manifest").write.partitionBy("manifest").text(folder)
    return folder


@query("s2_manifests", ["b_manifests"], f"WITH {S_PLACED} SELECT ticker, source_file, fetched_at, doc_id, status, period_end, seq FROM placed")
def s2(t):
    rows = R.read_manifests(t.spark, land_manifests(t), file_name=manifest_name("_metadata.file_path"))
    return rows.select("ticker", "source_file", "fetched_at", "doc_id", "status", "period_end", "seq")


@query("s2_manifest_errors", ["b_manifests"], """SELECT '{"ticker": "' || doc_id AS payload FROM b_manifests WHERE seq % 5000 = 0""")
def s2_errors(t):
    return R.manifest_errors(t.spark, land_manifests(t)).select("payload")


@query("s3_filer_master_csv", ["b_securities"], """
SELECT edinet_code, company_name, sec_code, fye_text, hp FROM b_securities WHERE listing NOT IN ('', '非上場')""")
def s3(t):
    folder = shared_folder(t.spark, "filers")
    names = [f.split()[0] for f in R.FILER_SCHEMA.split(", ")]
    t.b_securities.select(
        *[F.col(n) if n in t.b_securities.columns else F.lit("x").alias(n) for n in names]
    ).write.option("header", "true").csv(folder)
    return R.read_filer_csv(t.spark, folder).select("edinet_code", "company_name", "sec_code", "fye_text", "hp")


@query("s4_listed_info", ["b_securities"], """SELECT sec_code AS "Code", company_name AS "CompanyName", industry AS "Sector33CodeName" FROM b_securities""")
def s4(t):
    folder = shared_folder(t.spark, "listed")
    t.b_securities.select(
        F.col("sec_code").alias("Code"), F.col("company_name").alias("CompanyName"), F.col("industry").alias("Sector33CodeName")
    ).write.json(folder)
    return R.read_listed_info(t.spark, folder).select("Code", "CompanyName", "Sector33CodeName")


@query("s5_statements", ["b_raw_statements"], """
WITH f AS (SELECT *, CASE WHEN seq % 5 = 0 THEN 'statements_raw_9.json' ELSE 'statements_' || left("DisclosedDate", 4) || '.json' END AS file FROM b_raw_statements),
n AS (SELECT ticker, max(file) AS file FROM f WHERE NOT contains(file, 'raw') GROUP BY ticker)
SELECT f.ticker, f."DisclosedDate", f."NetSales", f.file FROM f JOIN n USING (ticker, file)""")
def s5(t):
    folder = shared_folder(t.spark, "statements")
    name = F.when(F.col("seq") % 5 == 0, "statements_raw_9.json").otherwise(
        F.concat(F.lit("statements_"), F.substring("DisclosedDate", 1, 4), F.lit(".json"))
    )
    t.b_raw_statements.select(
        "ticker", "DisclosedDate", "TypeOfCurrentPeriod", "CurrentFiscalYearEndDate", "NetSales", "OperatingProfit", "EarningsPerShare", name.alias("file")
    ).write.partitionBy("file").json(folder)
    return R.read_statements(t.spark, folder, file_name=F.col("file")).select("ticker", "DisclosedDate", "NetSales", "file")


@query("s5_statement_records", ["b_raw_statements"], rf"""
SELECT ticker, CAST("DisclosedDate" AS DATE) AS disclosed_date, "TypeOfCurrentPeriod" AS type_of_current_period, CAST("CurrentFiscalYearEndDate" AS DATE) AS fiscal_year_end,
 CASE WHEN regexp_matches({s_strip("replace(NetSales, ',', '')")}, '^[+-]?[0-9]+$') THEN TRY_CAST({s_strip("replace(NetSales, ',', '')")} AS BIGINT) END AS revenue,
 CASE WHEN regexp_matches({s_strip("replace(OperatingProfit, ',', '')")}, '^[+-]?[0-9]+$') THEN TRY_CAST({s_strip("replace(OperatingProfit, ',', '')")} AS BIGINT) END AS operating_income FROM b_raw_statements""")
def s5_records(t):
    return R.statement_records(t.b_raw_statements)


@query("s6_daily_quotes", ["events"], """
SELECT CAST(user_id AS VARCHAR) AS "Code", CAST(CAST(ts AS DATE) AS VARCHAR) AS "Date", value AS "Close", event_id::DOUBLE AS "Volume" FROM events""")
def s6(t):
    folder = shared_folder(t.spark, "quotes")
    t.events.select(
        F.col("user_id").cast("string").alias("Code"), F.col("ts").cast("date").cast("string").alias("Date"),
        F.col("value").alias("Close"), F.col("event_id").cast("double").alias("Volume"),
    ).write.json(folder)
    return R.read_quotes(t.spark, folder).select("Code", "Date", "Close", "Volume")


_XMLNS = 'xmlns="http://www.xbrl.org/2003/instance" xmlns:jp="http://example.com/jp"'


def _stored_zip(members: list[tuple[bytes, bytes]]) -> bytes:
    """An archive of stored members, as zipfile writes it at a tenth of the speed."""
    parts, directory, at = [], [], 0
    for name, data in members:
        fixed = (20, 0, 0, 0, 33, zlib.crc32(data), len(data), len(data), len(name), 0)
        parts += [b"PK\3\4", struct.pack("<5H3L2H", *fixed), name, data]
        directory += [b"PK\1\2\x14\3", struct.pack("<5H3L5H2L", *fixed, 0, 0, 0, 0o600 << 16, at), name]
        at += 30 + len(name) + len(data)
    whole = b"".join(directory)
    return b"".join([*parts, whole, struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, len(members), len(members), len(whole), at, 0)])


def _zip_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Test archives: the instance among other members; every ninth is damaged."""
    for batch in batches:
        paths, contents = [], []
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            paths.append(f"file:/cache/O{key}.zip")
            contents.append(b"<html>error" if key % 9 == 0 else _stored_zip([
                (b"XBRL/AuditDoc/audit.xbrl", f"<xbrl {_XMLNS}/>".encode()),
                (b"XBRL/PublicDoc/main.xbrl", f"<xbrl {_XMLNS}>{body}</xbrl>".encode()),
                (b"readme.txt", b"x"),
            ]))
        yield pa.RecordBatch.from_pydict({"path": paths, "content": contents, "length": [len(c) for c in contents]})


def archives(t):
    """One archive per order with its line items as facts; an order has at most a few items."""
    c = F.col
    context = F.concat(F.lit("C"), (c("l_linenumber") % 3).cast("string"))
    fact = F.concat(
        F.lit("<jp:"), F.when(c("l_linenumber") % 2 == 0, "NetSales").otherwise("BusinessRisksTextBlock"), F.lit(' contextRef="'), context,
        F.when(c("l_tax") > 0.06, '" sign="-">').otherwise('">'), F.lit(" "), c("l_quantity").cast("int").cast("string"), F.lit(" &lt;b&gt;x &lt;/b&gt;</jp:"),
        F.when(c("l_linenumber") % 2 == 0, "NetSales").otherwise("BusinessRisksTextBlock"), F.lit(">"),
    )
    contexts = (
        '<context id="C0"><period><instant> 2024-03-31 </instant></period></context>'
        '<context id="C1"><period><startDate>2023-04-01</startDate><endDate>2024-03-31</endDate></period></context>'
    )
    docs = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(fact)).alias("facts"))
    body = docs.select("l_orderkey", F.concat(F.lit(contexts), F.array_join("facts", "")).alias("body"))
    return body.mapInArrow(_zip_documents, "path string, content binary, length bigint")


@query("s7_xbrl_facts", ["lineitem"], """
SELECT 'O' || l_orderkey AS document_id, CASE WHEN l_linenumber % 2 = 0 THEN 'NetSales' ELSE 'BusinessRisksTextBlock' END AS concept, 'C' || l_linenumber % 3 AS context_id,
  ' ' || CAST(l_quantity AS INTEGER) || ' <b>x </b>' AS text, CASE WHEN l_tax > 6e-2 THEN '-' END AS sign, DATE '2024-03-31' AS period_end,
  CASE WHEN l_linenumber % 3 = 0 THEN 'instant' ELSE 'duration' END AS period_type, NULL::VARCHAR AS error FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_linenumber % 3 <> 2
UNION ALL SELECT DISTINCT 'O' || l_orderkey, NULL, NULL, NULL, NULL, NULL::DATE, 'unknown', 'BadZipFile' FROM lineitem WHERE l_orderkey % 9 = 0""")
def s7(t):
    return xbrl.xbrl_facts(archives(t)).select("document_id", "concept", "context_id", "text", "sign", "period_end", "period_type", "error")


@query("s8_narrative_blocks", ["lineitem"], """
SELECT 'O' || l_orderkey AS document_id, 'BusinessRisksTextBlock' AS element, CAST(l_quantity AS INTEGER) || ' x' AS text FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_linenumber % 2 = 1""")
def s8(t):
    return xbrl.narrative_blocks(archives(t)).drop("seq")


@query("s9_research", ["b_web_sources"], """SELECT ticker, seq, site, url, collected, error, per_text AS per FROM b_web_sources""")
def s9(t):
    folder = shared_folder(t.spark, "research")
    data = F.struct(F.struct(F.col("per_text").alias("per")).alias("indicators"))
    envelope = F.struct("url", "collected", "error", data.alias("data"))
    t.b_web_sources.select("ticker", F.col("seq").cast("string").alias("collected_at"), F.create_map("site", envelope).alias("sources")).write.json(folder)
    return R.read_research(t.spark, folder).select(
        "ticker", F.col("collected_at").cast("bigint").alias("seq"), "site", "url", "collected", "error",
        F.try_variant_get("data", "$.indicators.per", "string").alias("per"),
    )


@query("s10_page_text", ["b_pages"], "SELECT document_id, page_no, text FROM b_pages")
def s10(t):
    folder = shared_folder(t.spark, "page_text")
    return R.read_page_text(t.spark, sinks.write_table(t.b_pages, folder))


@query("s13_table_sinks", ["b_edinet"], "SELECT ticker, document_id, seq, revenue, total_assets FROM b_edinet")
def s13(t):
    folder = shared_folder(t.spark, "periods")
    rows = t.b_edinet.select("ticker", "document_id", "seq", "revenue", "total_assets")
    sinks.write_table(rows, folder, buckets=16)
    return t.spark.read.parquet(folder).drop("ticker_bucket")


@query("s14_corrupt_file_scan", ["lineitem"], """SELECT DISTINCT 'file:/cache/O' || l_orderkey || '.zip' AS path, 11::BIGINT AS length FROM lineitem WHERE l_orderkey % 9 = 0""")
def s14(t):
    return R.corrupt_files(archives(t))


# ------------------------------------------------------------------ streams

_ST1 = {"keyword": "半期報告書", "form_codes": ["030000", "043000"]}


def filing_stream(t) -> tuple:
    """The lists streamed in small batches, and once more under a new checkpoint, as after the loss of the first one."""
    source, target = land_filings(t), shared_folder(t.spark, "stream")
    for _ in range(2):
        out = jobs.filing_stream(t.spark, source, target, shared_folder(t.spark, "checkpoint"), files_per_batch=4, **_ST1)
    return out, jobs.read_errors(t.spark, f"{target}_errors")


@query("st1_filing_stream", ["b_filings"], """
SELECT "docID", "edinetCode", list_date FROM b_filings WHERE contains("docDescription", '半期報告書') AND "xbrlFlag" = '1' AND "formCode" IN ('030000', '043000')""")
def st1(t):
    return filing_stream(t)[0].select("docID", "edinetCode", "list_date")


@query("st1_filing_stream_errors", ["b_filings"], """SELECT '{"date": "' || docID AS payload FROM b_filings WHERE seq % 500 = 0""")
def st1_errors(t):
    return filing_stream(t)[1].select("payload")


def manifest_store(t) -> tuple:
    source, store, checkpoint = land_manifests(t), shared_folder(t.spark, "store"), shared_folder(t.spark, "checkpoint")
    rows = jobs.manifest_upsert(t.spark, source, store, checkpoint, files_per_batch=3, source_file=manifest_name("_file_path"))
    return rows, jobs.read_errors(t.spark, f"{store}_errors")


@query("st2_manifest_upsert", ["b_manifests"], f"""
WITH {S_PLACED} SELECT ticker, doc_id, fetched_at, source_file, status, period_end, seq FROM placed QUALIFY row_number() OVER (PARTITION BY ticker, doc_id ORDER BY fetched_at DESC, source_file, seq) = 1""")
def st2(t):
    return manifest_store(t)[0]


@query("st2_manifest_errors", ["b_manifests"], """SELECT '{"ticker": "' || doc_id AS payload FROM b_manifests WHERE seq % 5000 = 0""")
def st2_errors(t):
    return manifest_store(t)[1].select("payload")

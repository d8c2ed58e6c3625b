"""Readers: one per landed format, each with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILING_FIELDS = (
    "docID string, edinetCode string, secCode string, docTypeCode string, formCode string, docDescription string, "
    "xbrlFlag string, filerName string, periodStart string, periodEnd string, submitDateTime string"
)
FILING_SCHEMA = f"date string, result_count bigint, results array<struct<{FILING_FIELDS.replace(' string', ':string')}>>, _corrupt_record string"

MANIFEST_SCHEMA = (
    "ticker string, fetched_at string, edinet_code string, results array<struct<doc_id:string,status:string,period_end:string,"
    "doc_description:string,file_path:string,error:string>>, _corrupt_record string"
)
LISTED_SCHEMA = (
    "Code string, CompanyName string, CompanyNameEnglish string, Sector17Code string, Sector17CodeName string, "
    "Sector33Code string, Sector33CodeName string, ScaleCategory string, MarketCode string, MarketCodeName string"
)
STATEMENT_SCHEMA = (
    "ticker string, DisclosedDate string, TypeOfDocument string, TypeOfCurrentPeriod string, CurrentFiscalYearEndDate string, "
    "NetSales string, OperatingProfit string, OrdinaryProfit string, Profit string, TotalAssets string, Equity string, "
    "CashFlowsFromOperatingActivities string, CashFlowsFromInvestingActivities string, EarningsPerShare string, BookValuePerShare string"
)
QUOTE_SCHEMA = "Code string, Date string, Open double, High double, Low double, Close double, Volume double"
FILER_SCHEMA = (
    "edinet_code string, filer_type string, listing string, consolidated string, capital string, fye_text string, "
    "company_name string, english_name string, kana string, address string, industry string, sec_code string, "
    "corporate_number string, hp string"
)
RESEARCH_SCHEMA = (
    "ticker string, company_name string, collected_at string, "
    "sources map<string, struct<url:string, collected:boolean, error:string, data:variant>>"
)


def _payloads(spark: SparkSession, path: str, schema: str, whole_file: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", str(whole_file).lower()).json(path)


def read_filing_index(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Rows of the daily filing lists; payloads that cannot be read are left out, see `filing_index_errors`."""
    payloads = _payloads(spark, path, FILING_SCHEMA, whole_file).filter(F.col("_corrupt_record").isNull())
    return payloads.select(F.col("date").try_cast("date").alias("list_date"), F.explode("results").alias("r")).select("list_date", "r.*")


def filing_index_errors(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Payloads that are no filing list, with their file."""
    payloads = _payloads(spark, path, FILING_SCHEMA, whole_file)
    return payloads.filter(F.col("_corrupt_record").isNotNull() | F.col("results").isNull()).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_corrupt_record").alias("payload")
    )


def read_manifests(spark: SparkSession, path: str, file_name: Column | None = None, whole_file: bool = False) -> DataFrame:
    """Manifest results tagged with their file, fetch time and place in the list; see `manifest_errors` for payloads of another shape."""
    payloads = _payloads(spark, path, MANIFEST_SCHEMA, whole_file).filter(F.col("_corrupt_record").isNull())
    source = file_name if file_name is not None else F.col("_metadata.file_name")
    return payloads.select(
        "ticker", source.alias("source_file"), F.coalesce("fetched_at", F.lit("")).alias("fetched_at"),
        F.posexplode("results").alias("pos", "r"),
    ).select("ticker", "source_file", "fetched_at", F.col("pos").cast("bigint").alias("seq"), "r.*")


def manifest_errors(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Payloads that are no manifest, with their file."""
    payloads = _payloads(spark, path, MANIFEST_SCHEMA, whole_file)
    return payloads.filter(F.col("_corrupt_record").isNotNull() | F.col("results").isNull()).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_corrupt_record").alias("payload")
    )


def read_filer_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Filer list. For cp932 files give `windows-31j` and set `spark.sql.legacy.javaCharsets`."""
    from ledgerloom.operators.securities import listed_filers

    rows = spark.read.schema(FILER_SCHEMA).option("header", "true").option("encoding", encoding).csv(path)
    return listed_filers(rows)


def _records(spark: SparkSession, path: str, schema: str, whole_file: bool) -> DataFrame:
    """Rows of a record file: one JSON object per line, or with ``whole_file`` one array or object per file, indented or not.
    Text that is neither gives a row with ``_corrupt_record`` set, see `unreadable`."""
    rows = spark.read.schema(schema + ", _corrupt_record string").option("multiLine", str(whole_file).lower())
    return rows.option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def _readable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def unreadable(spark: SparkSession, path: str, schema: str, whole_file: bool = False) -> DataFrame:
    """File and text of what is no record of ``schema``."""
    rows = _records(spark, path, schema, whole_file).select(F.col("_metadata.file_name").alias("file_name"), "*")
    # Spark wants a query of corrupt records to read an ordinary column too; all of them are null there.
    first = schema.split(" ", 1)[0]
    return rows.filter(F.col("_corrupt_record").isNotNull() & F.col(first).isNull()).select("file_name", F.col("_corrupt_record").alias("payload"))


def read_listed_info(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return _readable(_records(spark, path, LISTED_SCHEMA, whole_file))


def read_statements(spark: SparkSession, path: str, whole_file: bool = False, file_name: Column | None = None) -> DataFrame:
    """Statements of each company's newest file.

    The file is known by its own name, or by ``file_name``; files of raw responses do not count. The newest names are one row
    per company, joined back, so the statements are not sorted. A company is named in its rows, or else by the folder of the file.
    """
    source = F.col("_metadata.file_name") if file_name is None else file_name
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    schema = STATEMENT_SCHEMA if file_name is None else STATEMENT_SCHEMA + ", file string"
    rows = _records(spark, path, schema, whole_file).select("*", source.alias("_source"), folder.alias("_folder"))
    rows = rows.withColumn("file", F.col("_source")).withColumn("ticker", F.coalesce("ticker", "_folder")).drop("_source", "_folder")
    kept = _readable(rows).filter(~F.contains("file", F.lit("statements_raw_")))
    newest = kept.groupBy("ticker").agg(F.max("file").alias("file"))
    return kept.join(newest, ["ticker", "file"])


def read_quotes(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return _readable(_records(spark, path, QUOTE_SCHEMA, whole_file))


def read_research(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """One row per company and source of the research files, the payload as VARIANT."""
    rows = _readable(_records(spark, path, RESEARCH_SCHEMA, whole_file))
    return rows.select("ticker", "company_name", "collected_at", F.explode("sources").alias("site", "s")).select(
        "ticker", "company_name", "collected_at", "site", "s.*"
    )


def read_page_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("document_id string, page_no int, text string").parquet(path)


def statement_records(raw: DataFrame) -> DataFrame:
    """Raw statements under the names of the merged record, with strict numbers."""
    from ledgerloom.functions.numbers import strict_integer

    # Raw name of each figure.
    names = {
        "NetSales": "revenue", "OperatingProfit": "operating_income", "OrdinaryProfit": "ordinary_income", "Profit": "net_income",
        "TotalAssets": "total_assets", "Equity": "equity", "CashFlowsFromOperatingActivities": "operating_cf",
        "CashFlowsFromInvestingActivities": "investing_cf",
    }
    return raw.select(
        "ticker", F.col("DisclosedDate").try_cast("date").alias("disclosed_date"),
        F.col("TypeOfCurrentPeriod").alias("type_of_current_period"),
        F.col("CurrentFiscalYearEndDate").try_cast("date").alias("fiscal_year_end"),
        *[strict_integer(F.col(k)).alias(v) for k, v in names.items() if k in raw.columns],
    )


def corrupt_files(files: DataFrame, small: int | None = None) -> DataFrame:
    """Zip and PDF files of a `binaryFile` frame that do not begin as such a file does: empty ones, HTML error pages of any
    length and the like. ``small`` limits the look to files below that many bytes; by default all are looked at.

    A PDF may have white space before its mark. Only the leading bytes are compared.
    """
    head = F.decode(F.substring("content", 1, 1024), "ISO-8859-1")
    is_zip, is_pdf = F.lower("path").endswith(".zip"), F.lower("path").endswith(".pdf")
    wrong = (is_zip & ~head.startswith("PK")) | (is_pdf & ~F.regexp_replace(head, r"^\s+", "").startswith("%PDF"))
    looked_at = F.lit(True) if small is None else F.col("length") < small
    return files.filter((is_zip | is_pdf) & ((F.col("length") == 0) | (looked_at & wrong))).select("path", "length")

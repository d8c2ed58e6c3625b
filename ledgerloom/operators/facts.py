"""From statement facts to resolved figures, period rows and the company's period index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.numbers import strip, with_sign, xbrl_figure
from ledgerloom.operators.ranking import landed
from ledgerloom.rules.concepts import (
    ALL_FIELDS, COMPANY_NAME_CONCEPTS, FACT_FIELDS, canonical_concept, concept_key, context_priority,
)


def concept_dictionary(facts: DataFrame) -> DataFrame:
    """(concept, canonical) of the element names that facts use and that have a canonical concept.

    Every distinct name is mapped once. The result is written, since the size of what was written is what Spark judges when it
    plans the join: a small dictionary is broadcast, one beyond the threshold is not.
    """
    names = facts.select("concept").distinct()
    mapped = names.select("concept", canonical_concept(F.col("concept")).alias("canonical"))
    return landed(mapped.filter(F.col("canonical").isNotNull()))


def numeric_facts(facts: DataFrame) -> DataFrame:
    """Facts of wanted concepts with their numeric value, which may be missing."""
    wanted = facts.join(concept_dictionary(facts), "concept")
    read = wanted.select("ticker", "document_id", "context_id", "seq", F.col("canonical").alias("concept"), xbrl_figure(F.col("text")).alias("figure"), "sign")
    # The number is read in a step of its own, so that both branches of the sign use it.
    return read.select("ticker", "document_id", "context_id", "seq", "concept", with_sign(F.col("figure"), F.col("sign")).alias("value"))


def context_facts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Last figure per document, context and concept, with the context's period.

    Within one context all facts have the same priority, so the later one wins before the contexts are
    looked up. That shrinks a document to one row per context and concept ahead of the join, and no
    document, however long, makes a large join group. Facts without a known context drop out.
    """
    place = F.when(F.col("value").isNotNull(), F.col("seq"))
    last = (
        numeric_facts(facts)
        .groupBy("ticker", "document_id", "context_id", "concept")
        .agg(F.max_by("value", place).alias("value"), F.max(place).alias("seq"), F.min(place).alias("first_seq"))
        .filter(F.col("seq").isNotNull())
    )
    return last.join(contexts, ["document_id", "context_id"]).withColumn(
        "priority", context_priority(F.col("context_id"))
    )


def _resolved(rows: DataFrame) -> DataFrame:
    """Best figure per document, period and concept, over rows laid out by document and period.

    Priority and place are one decimal, so one hash aggregation finds the figure; a maximum over a pair would sort, and two
    aggregations would hold all figures of a task twice.
    """
    # A priority goes before any place: places have at most 19 digits.
    order = F.col("priority").cast("decimal(10,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)") + F.col("seq").cast("decimal(20,0)")
    return rows.groupBy("ticker", "document_id", "period_end", "concept").agg(
        F.max_by("value", order).alias("value"), F.max("priority").alias("priority")
    )


def _laid_out(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    return context_facts(facts, contexts).repartition("document_id", "period_end")


def resolve_facts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """One figure per document, period and concept: highest context priority, on ties the later fact."""
    return _resolved(_laid_out(facts, contexts))


def period_rows(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """One row per document and period with a column per field.

    The figures are laid out by document and period once. Marking the best figure of a concept, turning
    concepts into columns and listing the contexts all work on that layout without a new shuffle. A
    window holds the contexts of one concept, a group those of one document and period.
    """
    best = Window.partitionBy("document_id", "period_end", "concept").orderBy(F.desc("priority"), F.desc("seq"))
    rows = _laid_out(facts, contexts).withColumn("place", F.row_number().over(best))
    is_kind = lambda kind: F.max(F.col("period_type") == kind)
    used = F.collect_set(F.struct("first_seq", "context_id"))
    return (
        rows.groupBy("document_id", "period_end", "ticker")
        .agg(
            F.when(is_kind("instant") & is_kind("duration"), "mixed")
            .when(is_kind("instant"), "instant").when(is_kind("duration"), "duration").otherwise("unknown")
            .alias("period_type"),
            F.min_by("start_date", F.when(F.col("start_date").isNotNull(), F.col("first_seq"))).alias("period_start"),
            F.array_distinct(F.transform(F.array_sort(used), lambda x: x["context_id"])).alias("source_context_ids"),
            *[F.max(F.when((F.col("place") == 1) & (F.col("concept") == c), F.col("value"))).alias(c) for c in FACT_FIELDS],
        )
        .withColumn("fiscal_year", F.year("period_end"))
    )


def derive_totals(periods: DataFrame) -> DataFrame:
    """Fill totals from their parts and add the free cash flow; names what was calculated."""
    c = F.col
    assets = F.coalesce(c("total_assets"), c("current_assets") + c("noncurrent_assets"))
    filled = periods.select(
        *[x for x in periods.columns if x not in ("total_assets", "total_liabilities", "free_cash_flow")],
        assets.alias("total_assets"),
        F.coalesce(
            c("total_liabilities"), c("current_liabilities") + c("noncurrent_liabilities"), assets - c("net_assets")
        ).alias("total_liabilities"),
        (c("operating_cf") + c("investing_cf")).alias("free_cash_flow"),
        c("total_assets").isNull().alias("no_assets"), c("total_liabilities").isNull().alias("no_liabilities"),
    )
    named = lambda cond, name: F.when(cond, F.lit(name))
    return filled.withColumn(
        "calculated_fields",
        F.array_compact(
            F.array(
                named(c("free_cash_flow").isNotNull(), "free_cash_flow"),
                named(c("no_assets") & c("total_assets").isNotNull(), "total_assets"),
                named(c("no_liabilities") & c("total_liabilities").isNotNull(), "total_liabilities"),
            )
        ),
    ).drop("no_assets", "no_liabilities")


def company_names(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """First filer name of each document, in element order."""
    text = strip(F.col("text"))
    named = facts.filter(concept_key(F.col("concept")).isin(*COMPANY_NAME_CONCEPTS) & (text != "")).select(
        "document_id", "context_id", "seq", text.alias("name")
    )
    return (
        named.join(contexts.select("document_id", "context_id"), ["document_id", "context_id"])
        .groupBy("document_id")
        .agg(F.min_by("name", F.struct("seq", "name")).alias("company_name"))
    )


def period_index(periods: DataFrame) -> DataFrame:
    """Per company and period end: first known value of each field in document order, with its documents, sorted.

    The calculated fields are three names at most. `period_documents` has the documents as rows.
    """
    first = lambda name: F.min(F.when(F.col(name).isNotNull(), F.struct("document_id", name)))[name].alias(name)
    opening = F.min(F.struct("document_id", "period_start", "period_type", "fiscal_year"))
    return periods.groupBy("ticker", "period_end").agg(
        opening["period_start"].alias("period_start"),
        opening["period_type"].alias("period_type"),
        opening["fiscal_year"].alias("fiscal_year"),
        *[first(f) for f in ALL_FIELDS],
        F.array_sort(F.collect_set("document_id")).alias("source_document_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("calculated_fields")))).alias("calculated_fields"),
    )


def period_documents(periods: DataFrame) -> DataFrame:
    """The documents behind each entry of the period index, one row each: a period of very many documents makes no long value."""
    return periods.select("ticker", "period_end", "document_id").distinct()


VERSIONED_NAME = r"_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{2})_[0-9]{4}-[0-9]{2}-[0-9]{2}\.xbrl$"


def latest_corrections(files: DataFrame) -> DataFrame:
    """Highest version per form prefix and period end; files with other names all stay."""
    name = F.col("member")
    version = F.regexp_extract(name, VERSIONED_NAME, 2)
    parsed = files.select(
        "*",
        F.regexp_extract(name, VERSIONED_NAME, 1).alias("name_period_end"),
        F.regexp_replace(name, VERSIONED_NAME, "").alias("name_prefix"),
        version.try_cast("int").alias("version"),
    )
    matched = parsed.filter(F.col("version").isNotNull())
    row = F.struct(*[F.col(c) for c in files.columns])
    # Versions rank upward and, at equal versions, the first file in path order stays.
    best = (
        matched.groupBy("ticker", "name_prefix", "name_period_end")
        .agg(F.min(F.struct((-F.col("version")).alias("rank"), F.col("seq"), row.alias("file")))["file"].alias("file"))
        .select("file.*")
    )
    return best.unionByName(parsed.filter(F.col("version").isNull()).select(*files.columns))

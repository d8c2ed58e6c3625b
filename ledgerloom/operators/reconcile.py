"""Reconciling two sources within a tolerance, and figures known to be absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import fiscal_year
from ledgerloom.functions.numbers import non_null_count, round_to
from ledgerloom.functions.text import header_unit
from ledgerloom.rules.concepts import COMPARE_FIELDS, STRUCTURED_ITEMS

TOLERANCE = 0.0001


def drop_all_null(rows: DataFrame) -> DataFrame:
    """Rows with at least one of the compared figures."""
    return rows.filter(F.coalesce(*[F.col(f) for f in COMPARE_FIELDS]).isNotNull())


def richest_entry(rows: DataFrame, extra: list[str]) -> DataFrame:
    """Per company and period the row with most compared figures, the first one on ties."""
    keep = [*extra, *COMPARE_FIELDS]
    order = F.struct(non_null_count(*[F.col(f) for f in COMPARE_FIELDS]).alias("known"), (-F.col("seq")).alias("place"))
    return (
        rows.groupBy("ticker", "period_end")
        .agg(F.max(F.struct(order.alias("order"), *[F.col(c) for c in keep])).alias("r"))
        .select("ticker", "period_end", *[F.col(f"r.{c}").alias(c) for c in keep])
    )


def verdict(left: Column, right: Column, tolerance: float) -> Column:
    """Struct (match, diff) of two figures; equal zeros match and a zero base never does otherwise."""
    # The base is kept away from zero before dividing: both branches of a `when` may be evaluated.
    base = F.when(right != 0, F.abs(right.cast("double")))
    diff = F.abs(left.cast("double") - right.cast("double")) / base
    match = (
        F.when(left.isNull() & right.isNull(), "BOTH_NULL")
        .when(left.isNull(), "EDINET_NULL")
        .when(right.isNull(), "JQUANTS_NULL")
        .when((left == 0) & (right == 0), "MATCH")
        .when(right == 0, "MISMATCH")
        .when(diff <= tolerance, "MATCH")
        .otherwise("MISMATCH")
    )
    shown = F.when((left == 0) & (right == 0), F.lit(0.0)).otherwise(round_to(diff, 6))
    return F.struct(match.alias("match"), shown.alias("diff_pct"))


def reconcile(filings: DataFrame, statements: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per company and period with the verdict of each figure and of the period.

    Both sides have one row per key, so they are put together and grouped instead of joined outright.
    """
    side = lambda df, name: df.select("ticker", "period_end", F.lit(name).alias("side"), *COMPARE_FIELDS)
    of = lambda name, f: F.max(F.when(F.col("side") == name, F.col(f)))
    has = lambda name: F.max(F.col("side") == name)
    stacked = side(filings, "edinet").unionByName(side(statements, "jquants"))
    paired = stacked.groupBy("ticker", "period_end").agg(
        has("edinet").alias("in_edinet"), has("jquants").alias("in_jquants"),
        *[of("edinet", f).alias(f"e_{f}") for f in COMPARE_FIELDS],
        *[of("jquants", f).alias(f"j_{f}") for f in COMPARE_FIELDS],
    )
    both = F.col("in_edinet") & F.col("in_jquants")
    coverage = F.when(both, "overlap").when(F.col("in_edinet"), "edinet_only").otherwise("jquants_only")
    judged = paired.select(
        "ticker", "period_end", coverage.alias("coverage"),
        *[
            F.when(both, verdict(F.col(f"e_{f}"), F.col(f"j_{f}"), tolerance)).alias(f) for f in COMPARE_FIELDS
        ],
    )
    any_mismatch = reduce(lambda a, b: a | b, [F.col(f)["match"] == "MISMATCH" for f in COMPARE_FIELDS])
    all_null = reduce(lambda a, b: a & b, [F.col(f)["match"] == "BOTH_NULL" for f in COMPARE_FIELDS])
    overall = F.when(F.col("coverage") == "overlap",
                     F.when(all_null, "INVALID_COMPARISON").when(any_mismatch, "MISMATCH").otherwise("MATCH"))
    return judged.withColumn("overall", overall)


def reconcile_summary(result: DataFrame) -> DataFrame:
    """Counts per company."""
    n = lambda cond: F.count_if(cond)
    cov, all_ = F.col("coverage"), F.col("overall")
    return result.groupBy("ticker").agg(
        F.count("*").alias("total"), n(cov == "overlap").alias("overlap"),
        n(cov == "edinet_only").alias("edinet_only"), n(cov == "jquants_only").alias("jquants_only"),
        n(all_ == "MATCH").alias("match"), n(all_ == "MISMATCH").alias("mismatch"),
        n(all_ == "INVALID_COMPARISON").alias("invalid_comparison"),
    )


def structured_figures(cells: DataFrame) -> DataFrame:
    """Compared figures of structured statement tables: one row per document.

    The current value of a record is its highest column (the first cell on ties), in the unit named by
    the table header. Of several matching records the first one with a value counts, of several in one place the smallest amount. What decides is
    packed into one number, column before place and table before record, so every maximum and minimum is one of numbers: the
    aggregations run in hash tables, are combined before the shuffle, and texts are only keys.
    """
    keys = ["ticker", "doc_id", "doc_type_code", "period_end"]
    # A column, then the places below it in reverse: 19 digits hold any of them.
    below = F.lit(10).cast("decimal(2,0)") * F.lit(10**18).cast("decimal(19,0)")
    rank = F.col("column_index").cast("decimal(10,0)") * below.cast("decimal(20,0)") - F.col("seq").cast("decimal(19,0)")
    current = (
        cells.groupBy(*keys, "section", "table_no", "record_no", "item", "header")
        .agg(F.max_by("parsed", rank.cast("decimal(38,0)")).alias("parsed"))
        .filter(F.col("parsed").isNotNull())
    )
    item = F.trim("item")

    def wanted(section: str, names: tuple[str, ...], how: str) -> Column:
        hit = item.isin(*names) if how == "exact" else F.contains(F.col("item"), F.lit(names[0]))
        return (F.col("section") == section) & hit

    field = F.coalesce(*[F.when(wanted(section, names, how), F.lit(f)) for f, section, names, how in STRUCTURED_ITEMS])
    place = F.shiftleft(F.col("table_no").cast("bigint"), 32) + F.col("record_no").cast("bigint")
    named = current.select(*keys, field.alias("field"), place.alias("place"), (F.col("parsed") * header_unit(F.col("header"))).alias("amount"))
    # Records that no one asks for only tell that the document has figures.
    at = F.when(F.col("field").isNotNull(), F.col("place"))
    per_place = named.groupBy(*keys, "field", at.alias("place")).agg(F.min("amount").alias("amount"))
    figure = lambda name: F.min_by("amount", F.when(F.col("field") == name, F.col("place")))
    return per_place.groupBy(*keys).agg(*[figure(f).alias(f) for f, *_ in STRUCTURED_ITEMS])


def absence_flags(metrics: DataFrame, absences: DataFrame) -> DataFrame:
    """Metric rows with the fields confirmed absent in their fiscal year.

    The fiscal year of the absence's period end is computed first, so the range test becomes an equal
    join; a later period overrides an earlier one for the same field.
    """
    year = fiscal_year(F.col("period_end"), F.col("fye_month"))
    latest = (
        absences.groupBy("ticker", year.alias("fiscal_year"), "field")
        .agg(F.max(F.struct("period_end", "reason"))["reason"].alias("reason"))
    )
    return metrics.join(latest, ["ticker", "fiscal_year"]).select("ticker", "fiscal_year", "field", "reason")


def infer_fye_month(comparisons: DataFrame) -> DataFrame:
    """Month of the first full-year period per company, December when there is none."""
    full_year = F.when(F.col("type_of_current_period") == "FY", F.col("period_end"))
    return comparisons.groupBy("ticker").agg(
        F.coalesce(F.month(F.min(full_year)), F.lit(12)).alias("fye_month")
    )

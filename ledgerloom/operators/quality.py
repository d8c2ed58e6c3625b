"""Quality gates over whole tables: one result row per company and gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.numbers import let, round_to
from ledgerloom.rules import gates as G

Rules = dict[str, tuple[float | None, float | None]]


def null_rate(periods: DataFrame, threshold: float = G.NULL_RATE_THRESHOLD, expected: DataFrame | None = None) -> DataFrame:
    """Share of unknown cells per company; companies without periods fail with rate one."""
    fields = G.NULL_RATE_FIELDS
    nulls = reduce(lambda a, b: a + b, [F.col(f).isNull().cast("bigint") for f in fields])
    counted = periods.groupBy("ticker").agg(
        (F.count("*") * len(fields)).alias("total_cells"), F.sum(nulls).alias("null_cells")
    )
    if expected is not None:
        counted = expected.select("ticker").join(counted, "ticker", "left").na.fill(0, ["total_cells", "null_cells"])
    rate = F.when(F.col("total_cells") > 0, F.col("null_cells") / F.col("total_cells")).otherwise(1.0)
    return counted.select("ticker", "total_cells", "null_cells", round_to(rate, 4).alias("null_rate"), (rate <= threshold).alias("pass"))


def key_coverage(periods: DataFrame, requirements: dict = G.KEY_REQUIREMENTS) -> DataFrame:
    """Per company and statement: keys known in all periods that know any of them."""
    aggregates = []
    for section, (keys, _) in requirements.items():
        any_key = F.coalesce(*[F.col(k) for k in keys]).isNotNull()
        aggregates.append(F.count_if(any_key).alias(f"{section}__periods"))
        aggregates += [F.count(k).alias(f"{section}__{k}") for k in keys]
    counted = periods.groupBy("ticker").agg(*aggregates)

    def result(section: str) -> Column:
        keys, minimum = requirements[section]
        total = F.col(f"{section}__periods")
        full = reduce(lambda a, b: a + b, [(F.col(f"{section}__{k}") == total).cast("int") for k in keys])
        full = F.when(total > 0, full).otherwise(0)
        return F.struct(
            F.lit(section).alias("section"), total.alias("periods"), full.alias("all_period_keys"),
            ((total > 0) & (full >= minimum)).alias("pass"),
        )

    return counted.select("ticker", F.explode(F.array(*[result(s) for s in requirements])).alias("r")).select("ticker", "r.*")


def value_range(rows: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Values outside their bounds, one row per broken bound; unknown values are skipped.

    The rules are constants, so each row yields a short array of its violations and no table is joined.
    """
    def broken(name: str, value: Column, bound: float | None, side: str) -> Column:
        if bound is None:
            return F.lit(None).cast("struct<concept:string,value:double,rule:string>")
        outside = value < bound if side == "min" else value > bound
        return F.when(
            outside,
            F.struct(F.lit(name).alias("concept"), value.alias("value"), F.lit(f"{side}={bound:g}").alias("rule")),
        )

    checks = []
    for name, (low, high) in rules.items():
        value = F.col(name).cast("double")
        checks += [broken(name, value, low, "min"), broken(name, value, high, "max")]
    return rows.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(*keys, "v.*")


def value_presence(rows: DataFrame, fields: dict[str, float]) -> DataFrame:
    """Known share of each field per company against its threshold."""
    counted = rows.groupBy("ticker").agg(F.count("*").alias("total"), *[F.count(f).alias(f) for f in fields])
    limits = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    rate = F.col("non_null") / F.col("total")
    return counted.unpivot(["ticker", "total"], list(fields), "field", "non_null").select(
        "ticker", "field", "non_null", "total", round_to(rate, 4).alias("presence_rate"),
        (rate >= F.try_element_at(limits, F.col("field"))).alias("pass"),
    )


def valuation_bounds(profile: str = "default", overrides: Rules | None = None) -> Rules:
    """Bounds of a profile; an override replaces the given sides only."""
    merged = dict(G.VALUATION_PROFILES.get(profile, G.VALUATION_PROFILES["default"]))
    for name, (low, high) in (overrides or {}).items():
        old = merged.get(name, (None, None))
        merged[name] = (old[0] if low is None else low, old[1] if high is None else high)
    return merged


def valuation_reasonableness(multiples: DataFrame, profile: str = "default", overrides: Rules | None = None) -> DataFrame:
    return value_range(multiples, ["ticker"], valuation_bounds(profile, overrides))


# How the type names of each kind begin.
_KINDS = {
    "text": ("STRING",), "number": ("DECIMAL", "BIGINT", "DOUBLE", "TINYINT", "SMALLINT", "INT", "FLOAT"), "object": ("OBJECT",),
    "array": ("ARRAY",), "boolean": ("BOOLEAN",), "null": ("VOID",),
}
# Where a field of a record may lie, in order of preference.
LEVELS = ("$.cf", "$.pl", "$.bs", "$")


def shredded(record: Column, levels: tuple[str, ...] = LEVELS, fields: list[str] | None = None) -> Column:
    """Array of (path, kind) maps of a VARIANT record, one per level: the kind of value behind each field of the object there.

    A level that is absent or no object is an empty map. Kinds are number, text, boolean, object, array and null. With ``fields`` only
    these are looked at.
    """
    def kinds(path: str) -> Column:
        found = F.try_variant_get(record, path, "map<string,variant>")
        if fields is not None:
            found = F.map_filter(found, lambda name, _: name.isin(*fields))
        return F.coalesce(F.transform_values(found, lambda _, v: _kind(v)), F.create_map().cast("map<string,string>"))

    return F.array(*[kinds(p) for p in levels])


def _kind(value: Column) -> Column:
    """The type name is worked out once; a missing value has another kind."""
    def of(actual: Column) -> Column:
        out = F.lit("other")
        for kind, names in reversed(_KINDS.items()):
            out = F.when(reduce(lambda a, b: a | b, [actual.startswith(n) for n in names]), kind).otherwise(out)
        return out

    return let(F.schema_of_variant(value), of)


def type_mismatches(rows: DataFrame, keys: list[str], record: str, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Fields of a VARIANT record whose value has another kind than a map expects; nulls are allowed.

    The record is taken apart once, whatever the number of maps. A field is looked up inside cf, pl and bs, then at the top level; what was
    found is compared with the maps that know the field. A boolean is never a number. All of this is done by functions on arrays: one
    expression per field and level would be too long to be compiled.
    """
    rules: dict[str, list[Column]] = {}
    for name, expected in maps.items():
        for field, kind in expected.items():
            rules.setdefault(field, []).append(F.struct(F.lit(name).alias("map"), F.lit(kind).alias("expected")))
    known = F.create_map(*[x for field, its in rules.items() for x in (F.lit(field), F.array(*its))])
    parts = rows.select(*keys, shredded(F.col(record), fields=sorted(rules)).alias("levels"))

    def first_found(level: int) -> Column:
        earlier = [F.col("levels")[i] for i in range(level)]
        new = lambda field, kind: reduce(lambda a, b: a & b, [~F.map_contains_key(m, field) for m in earlier], kind != "null")
        return F.map_entries(F.map_filter(F.col("levels")[level], new))

    def wrong(e: Column) -> Column:
        others = F.filter(F.try_element_at(known, e["key"]), lambda r: r["expected"] != e["value"])
        return F.transform(others, lambda r: F.struct(r["map"], e["key"].alias("field"), r["expected"], e["value"].alias("actual")))

    found = parts.select(*keys, F.flatten(F.array(*[first_found(i) for i in range(len(LEVELS))])).alias("found"))
    judged = found.select(*keys, F.flatten(F.transform("found", wrong)).alias("wrong"))
    # An inner explode would put a filter on the array below it and work out the record twice.
    return judged.select(*keys, F.explode_outer("wrong").alias("m")).filter(F.col("m").isNotNull()).select(*keys, "m.*")


def required_keys(rows: DataFrame, keys: list[str], record: str, paths: list[str]) -> DataFrame:
    """Required dotted paths that are missing from a VARIANT record."""
    missing = [
        F.when(F.coalesce(F.schema_of_variant(F.try_variant_get(record, f"$.{p}", "variant")), F.lit("VOID")) == "VOID", p)
        for p in paths
    ]
    names = F.array_compact(F.array(*missing))
    return rows.select(*keys, F.array_join(names, ",").alias("missing"), (F.size(names) == 0).alias("pass"))


def provenance_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that break the provenance contract, with the columns at fault."""
    absent = [c for c in G.PROVENANCE_COLUMNS if c not in rows.columns]
    if absent:
        raise ValueError(f"provenance columns missing: {absent}")
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    faults = [F.when(empty(c), c) for c in G.PROVENANCE_COLUMNS]
    faults.append(F.when(~F.col("source").isin(*G.PROVENANCE_SOURCES), "source_enum"))
    if "ticker" in rows.columns:
        faults.append(F.when(~F.col("ticker").rlike("^[0-9]{4}$"), "ticker_pattern"))
    names = F.array_compact(F.array(*faults))
    return rows.filter(F.size(names) > 0).select(*keys, F.array_join(names, ",").alias("faults"))


def dataset_exists(expected: DataFrame, **datasets: DataFrame) -> DataFrame:
    """Rows of each required dataset per expected company; an empty dataset fails."""
    out = None
    for name, df in datasets.items():
        counts = df.groupBy("ticker").agg(F.count("*").alias("n"))
        part = expected.select("ticker").join(counts, "ticker", "left").select(
            "ticker", F.lit(name).alias("dataset"), F.coalesce("n", F.lit(0)).alias("rows")
        )
        out = part if out is None else out.unionByName(part)
    return out.withColumn("pass", F.col("rows") > 0)


def count_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two datasets per company; both sides are counted before they meet."""
    n = lambda df, side: df.groupBy("ticker").agg(F.count("*").alias(side))
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = n(left, "actual").join(n(right, "expected"), "ticker", "full_outer")
    return joined.select("ticker", zero(F.col("actual")).alias("actual"), zero(F.col("expected")).alias("expected")).withColumn(
        "pass", F.col("actual") == F.col("expected")
    )


def field_check(rows: DataFrame, condition: Column, field: str) -> DataFrame:
    """Whether any record that meets the condition knows the field, and whether there are records."""
    return rows.groupBy("ticker").agg(
        F.count("*").alias("records"), F.coalesce(F.max(condition & F.col(field).isNotNull()), F.lit(False)).alias("pass")
    )


def statement_sanity(cells: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per document: total assets taken from current assets, and gross profit that does not add up.

    The last value of an item in a table decides; figures are compared inside one table.
    """
    current = (
        cells.groupBy("ticker", "doc_id", "section", "table_no", "record_no", "item")
        .agg(F.max(F.struct("column_index", (-F.col("seq")).alias("place"), "parsed"))["parsed"].alias("parsed"))
    )
    of = lambda section, item: F.max(
        F.when((F.col("section") == section) & (F.trim("item") == item), F.struct("record_no", "parsed"))
    )["parsed"]
    tables = current.groupBy("ticker", "doc_id", "table_no").agg(
        of("income_statement", "売上高").alias("revenue"), of("income_statement", "売上原価").alias("cogs"),
        of("income_statement", "売上総利益").alias("gross_profit"),
        F.max(F.when((F.col("section") == "balance_sheet") & (F.col("item") == "資産合計"), F.struct("record_no", "parsed"))).alias("assets"),
        F.max(F.when((F.col("section") == "balance_sheet") & (F.col("item") == "流動資産合計"), F.struct("record_no", "parsed"))).alias("current"),
    )
    off = (F.col("gross_profit") != 0) & (
        F.abs(F.col("revenue") - F.col("cogs") - F.col("gross_profit")) > F.abs("gross_profit") * tolerance
    )
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("table_no", F.col(c)["parsed"].alias("v"))))["v"]
    return tables.groupBy("ticker", "doc_id").agg(
        F.coalesce(last("assets") == last("current"), F.lit(False)).alias("assets_equal_current"),
        F.coalesce(F.max(off), F.lit(False)).alias("gross_profit_off"),
    )


def half_year_uncorrected(documents: DataFrame) -> DataFrame:
    """Half-year filings that still carry the fiscal year end."""
    return documents.filter(
        (F.col("doc_type_code") == "160") & (F.col("period_end") == F.col("period_end_original"))
    )


def zero_check(rows: DataFrame, column: str, gate: str) -> DataFrame:
    """Gate rows that pass when a counted column is zero."""
    return rows.select("ticker", F.lit(gate).alias("gate_id"), (F.coalesce(column, F.lit(0)) == 0).alias("pass"), F.col(column).alias("found"))


def missing_quarters(expected: DataFrame, start: str, end: str, *sources: DataFrame) -> DataFrame:
    """Quarter ends of the timeframe for which a company has data from no source."""
    quarters = F.transform(
        F.sequence(F.trunc(F.lit(start).cast("date"), "quarter"), F.lit(end).cast("date"), F.expr("interval 3 months")),
        lambda d: F.last_day(F.add_months(d, 2)),
    )
    grid = expected.select("ticker", F.explode(quarters).alias("period_end")).filter(F.col("period_end") <= F.lit(end).cast("date"))
    have = sources[0].select("ticker", "period_end")
    for s in sources[1:]:
        have = have.union(s.select("ticker", "period_end"))
    return grid.join(have.distinct(), ["ticker", "period_end"], "left_anti")


def gate_rollup(gates: DataFrame, overrides: DataFrame | None = None, companies: DataFrame | None = None) -> DataFrame:
    """Overall result per company: all error gates pass; failed warn gates are only listed.

    A company of ``companies`` without any gate has not passed: its overall result is false.
    """
    rows = gates
    if overrides is not None:
        new = overrides.select("ticker", "gate_id", F.col("severity").alias("new_severity"))
        rows = gates.join(new, ["ticker", "gate_id"], "left").withColumn("severity", F.coalesce("new_severity", "severity"))
    error = F.col("severity") == "error"
    if companies is not None:
        rows = companies.select("ticker").distinct().join(rows, "ticker", "left")
    count = F.count("gate_id")
    return rows.groupBy("ticker").agg(
        count.alias("gates"),
        ((count > 0) & F.coalesce(F.min(F.when(error, F.col("pass"))), F.lit(True))).alias("overall_pass"),
        F.array_join(F.array_sort(F.collect_set(F.when((F.col("severity") == "warn") & ~F.col("pass"), F.col("gate_id")))), ",").alias("warnings"),
    )

"""Queries: quality gates and change tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import inventory as inv
from ledgerloom.catalog import records as rec
from ledgerloom.catalog.registry import query
from ledgerloom.operators import changes as C
from ledgerloom.operators import inventory as I
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reconcile as R
from ledgerloom.rules import gates as G
from ledgerloom.rules.concepts import FACT_FIELDS, statement_of


def periods(t):
    return t.b_edinet.withColumn("free_cash_flow", F.col("operating_cf") + F.col("investing_cf"))


_NULLS = " + ".join(f"({'operating_cf + investing_cf' if f == 'free_cash_flow' else f} IS NULL)::INT" for f in G.NULL_RATE_FIELDS)
S_NULL = f"""nr AS (SELECT s.ticker, count(p.ticker) * {len(G.NULL_RATE_FIELDS)} AS total_cells, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS null_cells FROM b_securities s
  LEFT JOIN (SELECT ticker, {_NULLS} AS n FROM b_edinet) p ON p.ticker = s.ticker GROUP BY s.ticker)"""
_RATE = "CASE WHEN total_cells > 0 THEN null_cells / total_cells ELSE 1e0 END"


def null_rates(t):
    return Q.null_rate(periods(t), 0.2, t.b_securities)


@query("q1_null_rate", ["b_edinet", "b_securities"], f"WITH {S_NULL} SELECT ticker, total_cells, null_cells, round_even(({_RATE}) * 1e4, 0) / 1e4 AS null_rate, ({_RATE}) <= 2e-1 AS pass FROM nr")
def q1(t):
    return null_rates(t)


def _s_cov(section: str) -> str:
    keys, minimum = G.KEY_REQUIREMENTS[section]
    full = " + ".join(f"(count({k}) = count(coalesce({', '.join(keys)})))::INT" for k in keys)
    n = f"count(coalesce({', '.join(keys)}))"
    return (f"SELECT ticker, '{section}' AS section, {n} AS periods, CAST(CASE WHEN {n} > 0 THEN {full} ELSE 0 END AS INTEGER) AS all_period_keys, "
            f"{n} > 0 AND ({full}) >= {minimum} AS pass FROM b_edinet GROUP BY ticker")


S_COV = "cov AS (" + " UNION ALL ".join(_s_cov(s) for s in G.KEY_REQUIREMENTS) + ")"


@query("q2_key_coverage", ["b_edinet"], f"WITH {S_COV} SELECT * FROM cov")
def q2(t):
    return Q.key_coverage(periods(t))


_RULES = {"net_income": (0.0, 900000.0), "revenue": (1000000.0, None), "operating_income": (None, 2000000.0)}


@query("q3_value_range", ["b_edinet"], """
SELECT ticker, seq, 'net_income' AS concept, net_income::DOUBLE AS value, 'min=0' AS rule FROM b_edinet WHERE net_income < 0
UNION ALL SELECT ticker, seq, 'net_income', net_income::DOUBLE, 'max=900000' FROM b_edinet WHERE net_income > 900000
UNION ALL SELECT ticker, seq, 'revenue', revenue::DOUBLE, 'min=1e+06' FROM b_edinet WHERE revenue < 1000000
UNION ALL SELECT ticker, seq, 'operating_income', operating_income::DOUBLE, 'max=2e+06' FROM b_edinet WHERE operating_income > 2000000""")
def q3(t):
    return Q.value_range(t.b_edinet, ["ticker", "seq"], _RULES)


@query("q3_metrics_range", rec.DEPS, f"""WITH {rec.S_SNAP}
SELECT ticker, 'roe_percent' AS concept, roe_percent AS value, 'min=-5' AS rule FROM snap WHERE roe_percent < -5 UNION ALL
SELECT ticker, 'equity_ratio_percent', equity_ratio_percent, 'max=66' FROM snap WHERE equity_ratio_percent > 66""")
def q3_metrics(t):
    return Q.value_range(rec.snapshot(t), ["ticker"], {"roe_percent": (-5.0, None), "equity_ratio_percent": (None, 66.0)})


@query("q3_json_range", ["events"], "SELECT event_id, 'k' AS concept, json_extract_string(props, '$.k')::DOUBLE AS value, 'max=90' AS rule FROM events WHERE json_extract_string(props, '$.k')::DOUBLE > 90")
def q3_json(t):
    rows = t.events.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "double").alias("k"))
    return Q.value_range(rows, ["event_id"], {"k": (None, 90.0)})


@query("q4_value_presence", ["b_edinet"], """
SELECT ticker, f.field, f.n AS non_null, total, round_even(f.n / total * 1e4, 0) / 1e4 AS presence_rate, f.n / total >= f.th AS pass FROM
 (SELECT ticker, count(*) AS total, count(revenue) AS r, count(net_income) AS ni, count(period_start) AS ps FROM b_edinet GROUP BY ticker) c,
 LATERAL (VALUES ('revenue', r, 9e-1), ('net_income', ni, 95e-2), ('period_start', ps, 5e-1)) f(field, n, th)""")
def q4(t):
    return Q.value_presence(t.b_edinet, {"revenue": 0.9, "net_income": 0.95, "period_start": 0.5})


@query("q5_valuation_reasonableness", rec.VDEPS, f"""WITH {rec.S_REL}
SELECT ticker, 'per' AS concept, per AS value, 'min=0' AS rule FROM rel WHERE per < 0 UNION ALL SELECT ticker, 'per', per, 'max=20' FROM rel WHERE per > 20
UNION ALL SELECT ticker, 'pbr', pbr, 'min=0' FROM rel WHERE pbr < 0 UNION ALL SELECT ticker, 'pbr', pbr, 'max=3' FROM rel WHERE pbr > 3
UNION ALL SELECT ticker, 'ev_ebitda', ev_ebitda, 'min=0' FROM rel WHERE ev_ebitda < 0 UNION ALL SELECT ticker, 'ev_ebitda', ev_ebitda, 'max=25' FROM rel WHERE ev_ebitda > 25""")
def q5(t):
    return Q.valuation_reasonableness(rec.multiples(t), "value", {"per": (None, 20.0)})


# Every field of every map takes every kind of value in turn, at the top level or in one of the statements.
_Q6_FIELDS = sorted({f for fields in G.TYPE_MAPS.values() for f in fields})
_Q6_KINDS = ("number", "text", "boolean", "object", "array", "null", "number")
_Q6_JSON = ("12.5", '"s"', "true", '{"a": 1}', "[1]", "null", "-7")
_Q6_LEVELS = ("top", "bs", "pl", "cf")
_Q6_SQL = f"""
WITH f AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{f}')" for i, f in enumerate(_Q6_FIELDS))}) v(i, field)),
m AS (SELECT * FROM (VALUES {", ".join(f"('{m}', '{f}', '{k}')" for m, fields in G.TYPE_MAPS.items() for f, k in fields.items())}) v(map, field, expected)),
k AS (SELECT seq, field, [{", ".join(f"'{k}'" for k in _Q6_KINDS)}][(seq + i) % {len(_Q6_KINDS)} + 1] AS actual FROM b_raw_statements, f)
SELECT map, field, expected, actual, count(*) AS records, min(seq) AS first_seq, sum(seq)::BIGINT AS seq_sum
FROM k JOIN m USING (field) WHERE actual <> 'null' AND actual <> expected GROUP BY map, field, expected, actual"""


@query("q6_type_consistency", ["b_raw_statements"], _Q6_SQL)
def q6(t):
    values = F.array(*[F.lit(v) for v in _Q6_JSON])
    field = lambda f: F.concat(f["name"], F.element_at(values, ((F.col("seq") + f["i"]) % len(_Q6_JSON) + 1).cast("int")))
    at = lambda n: F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f'"{f}": ').alias("name")) for i, f in enumerate(_Q6_FIELDS) if i % len(_Q6_LEVELS) == n])
    level = lambda n: F.array_join(F.transform(at(n), field), ", ")
    parts = [F.concat(F.lit(f'"{name}": {{'), level(n), F.lit("}")) for n, name in enumerate(_Q6_LEVELS) if n]
    record = F.concat(F.lit("{"), F.concat_ws(", ", level(0), *parts), F.lit("}"))
    # A number becomes a record: the numbers are dealt out before that.
    narrow = t.b_raw_statements.select("seq").repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    rows = narrow.select("seq", F.try_parse_json(record).alias("record"))
    return Q.type_mismatches(rows, ["seq"], "record", G.TYPE_MAPS).groupBy("map", "field", "expected", "actual").agg(
        F.count("*").alias("records"), F.min("seq").alias("first_seq"), F.sum("seq").alias("seq_sum")
    )


@query("q7_required_keys", ["events"], """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'summary.total' WHEN event_id % 3 = 1 THEN '' ELSE 'summary.total,k' END AS missing, event_id % 3 = 1 AS pass FROM events""")
def q7(t):
    c = F.col
    doc = (
        F.when(c("event_id") % 3 == 0, c("props"))
        .when(c("event_id") % 3 == 1, F.concat(F.lit('{"summary": {"total": 1}, "k": '), F.get_json_object("props", "$.k"), F.lit("}")))
        .otherwise('{"summary": {"total": null}}')
    )
    rows = t.events.select("event_id", F.try_parse_json(doc).alias("doc"))
    return Q.required_keys(rows, ["event_id"], "doc", ["summary.total", "k"])


@query("q8_provenance_contract", ["b_manifests"], """
SELECT seq, concat_ws(',', CASE WHEN seq % 19 = 0 THEN 'source' END, CASE WHEN period_end IS NULL THEN 'period_end' END, CASE WHEN seq % 5 = 2 THEN 'source_enum' END, CASE WHEN NOT regexp_matches(ticker, '^[0-9]{4}$') THEN 'ticker_pattern' END) AS faults
FROM (SELECT *, CASE WHEN seq % 19 = 0 THEN NULL WHEN seq % 5 = 2 THEN 'scrape' ELSE 'edinet' END AS src FROM b_manifests)
WHERE seq % 19 = 0 OR period_end IS NULL OR src = 'scrape' OR NOT regexp_matches(ticker, '^[0-9]{4}$')""".replace("CASE WHEN seq % 5 = 2 THEN 'source_enum' END", "CASE WHEN src = 'scrape' THEN 'source_enum' END"))
def q8(t):
    c = F.col
    rows = t.b_manifests.withColumn("endpoint_or_doc_id", c("doc_id")).withColumn(
        "source", F.when(c("seq") % 19 != 0, F.when(c("seq") % 5 == 2, "scrape").otherwise("edinet"))
    )
    return Q.provenance_violations(rows, ["seq"])


@query("q9_dataset_exists", ["b_securities", "b_edinet", "b_raw_statements"], """
SELECT s.ticker, d.dataset, coalesce(CASE d.dataset WHEN 'filings' THEN e.n ELSE r.n END, 0) AS rows, coalesce(CASE d.dataset WHEN 'filings' THEN e.n ELSE r.n END, 0) > 0 AS pass
FROM b_securities s CROSS JOIN (VALUES ('filings'), ('statements')) d(dataset) LEFT JOIN (SELECT ticker, count(*) AS n FROM b_edinet GROUP BY 1) e ON e.ticker = s.ticker
LEFT JOIN (SELECT ticker, count(*) AS n FROM b_raw_statements GROUP BY 1) r ON r.ticker = s.ticker""")
def q9(t):
    return Q.dataset_exists(t.b_securities, filings=t.b_edinet, statements=t.b_raw_statements)


@query("q10_count_match", ["b_edinet", "b_statements"], """
SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.n, 0) AS actual, coalesce(b.n, 0) AS expected, coalesce(a.n, 0) = coalesce(b.n, 0) AS pass
FROM (SELECT ticker, count(*) AS n FROM b_edinet GROUP BY 1) a FULL OUTER JOIN (SELECT ticker, count(*) AS n FROM b_statements GROUP BY 1) b ON a.ticker = b.ticker""")
def q10(t):
    return Q.count_match(t.b_edinet, t.b_statements)


@query("q10_field_check", ["b_statements"], """
SELECT ticker, count(*) AS records, coalesce(bool_or(type_of_current_period = 'FY' AND period_end >= DATE '2025-01-01' AND operating_cf IS NOT NULL), false) AS pass FROM b_statements GROUP BY ticker""")
def q10_field(t):
    cond = (F.col("type_of_current_period") == "FY") & (F.col("period_end") >= F.lit("2025-01-01").cast("date"))
    return Q.field_check(t.b_statements, cond, "operating_cf")


_LAST = lambda section, item: f"arg_max(parsed, record_no) FILTER (WHERE section = '{section}' AND item = '{item}' AND parsed IS NOT NULL)"


@query("q11_statement_sanity", ["b_cells"], """
WITH cur AS (SELECT * FROM b_cells QUALIFY row_number() OVER (PARTITION BY doc_id, section, table_no, record_no, item ORDER BY column_index DESC, seq) = 1),
lst AS (SELECT * FROM cur QUALIFY row_number() OVER (PARTITION BY doc_id, section, table_no, item ORDER BY record_no DESC) = 1),
tb AS (SELECT ticker, doc_id, table_no, max(CASE WHEN item = '売上高' THEN parsed END) AS rev, max(CASE WHEN item = '売上原価' THEN parsed END) AS cogs, max(CASE WHEN item = '売上総利益' THEN parsed END) AS gp FROM lst GROUP BY ALL),
bs AS (SELECT * FROM lst WHERE item IN ('資産合計', '流動資産合計') QUALIFY row_number() OVER (PARTITION BY doc_id, item ORDER BY table_no DESC) = 1),
eq AS (SELECT doc_id, max(CASE WHEN item = '資産合計' THEN parsed END) = max(CASE WHEN item = '流動資産合計' THEN parsed END) AS same FROM bs GROUP BY doc_id)
SELECT tb.ticker, tb.doc_id, coalesce(any_value(eq.same), false) AS assets_equal_current, coalesce(bool_or(gp <> 0 AND abs(rev - cogs - gp) > abs(gp) * 1e-2), false) AS gross_profit_off
FROM tb LEFT JOIN eq ON eq.doc_id = tb.doc_id GROUP BY tb.ticker, tb.doc_id""")
def q11(t):
    return Q.statement_sanity(t.b_cells)


@query("q11_half_year_period", ["b_cells"], """
SELECT doc_id, period_end FROM (SELECT DISTINCT doc_id, doc_type_code, period_end, CASE WHEN month(period_end) > 6 THEN period_end END AS period_end_original FROM b_cells)
WHERE doc_type_code = '160' AND period_end = period_end_original""")
def q11_period(t):
    docs = t.b_cells.select(
        "doc_id", "doc_type_code", "period_end", F.when(F.month("period_end") > 6, F.col("period_end")).alias("period_end_original")
    ).distinct()
    return Q.half_year_uncorrected(docs).select("doc_id", "period_end")


S_GATES = f"""{inv.S_REC}, {S_NULL}, {S_COV},
g AS (SELECT ticker, 'manifest_check' AS gate_id, count(*) FILTER (WHERE status = 'failed') = 0 AS pass, count(*) FILTER (WHERE status = 'failed') AS found FROM b_manifests GROUP BY ticker
  UNION ALL SELECT ticker, 'reconciliation_check', count(*) FILTER (WHERE overall = 'INVALID_COMPARISON') = 0, count(*) FILTER (WHERE overall = 'INVALID_COMPARISON') FROM rec GROUP BY ticker)"""
GDEPS = ["b_manifests", "b_edinet", "b_statements", "b_securities"]


def checks(t):
    manifest = Q.zero_check(I.collection_stats(t.b_manifests), "failed", "manifest_check")
    return manifest.unionByName(Q.zero_check(R.reconcile_summary(inv.reconciled(t)), "invalid_comparison", "reconciliation_check"))


@query("q12_manifest_reconciliation", GDEPS, f"WITH {S_GATES} SELECT * FROM g")
def q12(t):
    return checks(t)


@query("q13_coverage_check", ["b_securities", "b_edinet", "b_statements"], """
WITH qs AS (SELECT last_day(CAST(d + INTERVAL 2 MONTH AS DATE)) AS period_end FROM (SELECT unnest(generate_series(DATE '2018-01-01', DATE '2025-12-31', INTERVAL 3 MONTH)) AS d))
SELECT s.ticker, qs.period_end FROM b_securities s, qs WHERE qs.period_end <= DATE '2025-12-31'
EXCEPT (SELECT ticker, period_end FROM b_edinet UNION SELECT ticker, period_end FROM b_statements)""")
def q13(t):
    return Q.missing_quarters(t.b_securities, "2018-02-15", "2025-12-31", t.b_edinet, t.b_statements)


@query("q14_gate_rollup", GDEPS, f"""WITH {S_GATES},
al AS (SELECT ticker, gate_id, 'error' AS severity, pass FROM g UNION ALL SELECT ticker, 'null_rate', 'warn', ({_RATE}) <= 2e-1 FROM nr
  UNION ALL SELECT ticker, 'key_coverage_' || section, 'error', pass FROM cov),
o AS (SELECT al.*, CASE WHEN gate_id = 'manifest_check' AND CAST(ticker AS INTEGER) % 2 = 0 THEN 'warn' WHEN gate_id LIKE 'key_coverage%' AND CAST(ticker AS INTEGER) % 3 = 0 THEN 'info' ELSE severity END AS sv FROM al)
SELECT ticker, count(*) AS gates, coalesce(bool_and(pass) FILTER (WHERE sv = 'error'), true) AS overall_pass,
  coalesce(string_agg(gate_id, ',' ORDER BY gate_id) FILTER (WHERE sv = 'warn' AND NOT pass), '') AS warnings FROM o GROUP BY ticker""")
def q14(t):
    gates = (
        checks(t).select("ticker", "gate_id", F.lit("error").alias("severity"), "pass")
        .unionByName(null_rates(t).select("ticker", F.lit("null_rate").alias("gate_id"), F.lit("warn").alias("severity"), "pass"))
        .unionByName(
            Q.key_coverage(periods(t)).select("ticker", F.concat(F.lit("key_coverage_"), "section").alias("gate_id"), F.lit("error").alias("severity"), "pass")
        )
    )
    number = F.col("ticker").cast("int")
    cover = F.array(*[F.lit(f"key_coverage_{s}") for s in G.KEY_REQUIREMENTS])
    overrides = t.b_securities.filter(number % 2 == 0).select("ticker", F.lit("manifest_check").alias("gate_id"), F.lit("warn").alias("severity")).unionByName(
        t.b_securities.filter(number % 3 == 0).select("ticker", F.explode(cover).alias("gate_id"), F.lit("info").alias("severity"))
    )
    return Q.gate_rollup(gates, overrides)


# ------------------------------------------------------------------ change tracking

_PATHS = {f: f"{statement_of(f)}.{f}" for f in FACT_FIELDS}
_LEAF = lambda f, x: f"('{_PATHS[f]}', CAST({x} AS VARCHAR))"
_NEWV = lambda f: f"CASE WHEN seq % 3 = 1 AND '{f}' = 'revenue' THEN {f} + 1 WHEN seq % 4 = 2 AND '{f}' = 'net_income' THEN NULL ELSE {f} END"
S_DIFF = f"""od AS (SELECT ticker, seq, l.path, l.value FROM b_edinet, LATERAL (VALUES {', '.join(_LEAF(f, f) for f in FACT_FIELDS)}) l(path, value) WHERE seq % 8 <> 1),
nw AS (SELECT ticker, seq, l.path, l.value FROM b_edinet, LATERAL (VALUES {', '.join(_LEAF(f, _NEWV(f)) for f in FACT_FIELDS)}) l(path, value) WHERE seq % 8 <> 3),
df AS (SELECT coalesce(o.ticker, n.ticker) AS ticker, coalesce(o.seq, n.seq) AS seq, coalesce(o.path, n.path) AS path,
   CASE WHEN o.ticker IS NULL THEN 'added' WHEN n.ticker IS NULL THEN 'removed' WHEN o.value IS DISTINCT FROM n.value THEN 'changed' END AS change, o.value AS old, n.value AS new
   FROM od o FULL OUTER JOIN nw n ON o.ticker = n.ticker AND o.seq = n.seq AND o.path = n.path)"""


def diffs(t):
    c = F.col
    fresh = t.b_edinet.filter(c("seq") % 8 != 3).withColumn(
        "revenue", F.when(c("seq") % 3 == 1, c("revenue") + 1).otherwise(c("revenue"))
    ).withColumn("net_income", F.when(c("seq") % 4 != 2, c("net_income")))
    keys = ["ticker", "seq"]
    return C.snapshot_diff(
        C.flatten_values(t.b_edinet.filter(c("seq") % 8 != 1), keys, _PATHS), C.flatten_values(fresh, keys, _PATHS), keys
    )


@query("d1_snapshot_diff", ["b_edinet"], f"WITH {S_DIFF} SELECT * FROM df WHERE change IS NOT NULL")
def d1(t):
    return diffs(t)


@query("d2_diff_summary", ["b_edinet"], f"""WITH {S_DIFF} SELECT ticker, count(*) AS changes, count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'removed') AS removed,
  count(*) FILTER (WHERE change = 'changed') AS changed FROM df WHERE change IS NOT NULL GROUP BY ticker""")
def d2(t):
    return C.diff_summary(diffs(t), ["ticker"])


@query("o4_first_n_diffs", ["b_edinet"], f"""WITH {S_DIFF} SELECT ticker, seq, path, change, CAST(row_number() OVER (PARTITION BY ticker ORDER BY seq, path) AS INTEGER) AS rank FROM df WHERE change IS NOT NULL QUALIFY rank <= 10""")
def o4(t):
    return C.first_diffs(diffs(t), ["ticker"], ["seq", "path"]).select("ticker", "seq", "path", "change", "rank")

"""Queries: facts, contexts, periods and the period index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.sqlkit import s_strip
from ledgerloom.operators import facts as O
from ledgerloom.rules.concepts import ALL_FIELDS, FACT_FIELDS, XBRL_ALIASES

_ALIASES = ", ".join(f"('{a}', '{c}')" for c, names in XBRL_ALIASES.items() for a in names)
DEPS = ["b_facts", "b_contexts"]

# Facts with canonical concept, value, context period and priority.
S_FACTS = rf"""cleaned AS (SELECT f.*, m.canonical, regexp_replace({s_strip('f.text')}, '[, ]', '', 'g') AS x FROM b_facts f
  JOIN (VALUES {_ALIASES}) m(alias, canonical) ON m.alias = regexp_replace(lower(f.concept), '[^0-9a-z]+', '', 'g')),
num AS (SELECT c.ticker, c.document_id, c.context_id, c.seq, c.canonical, k.period_end, k.start_date, k.period_type,
    CASE WHEN c.sign = '-' THEN -abs(CAST(x AS DOUBLE)) ELSE CAST(x AS DOUBLE) END AS value,
    (CASE WHEN contains(lower(c.context_id), 'currentyear') THEN 100 ELSE 0 END)
    + (CASE WHEN contains(lower(c.context_id), 'currentquarter') THEN 50 WHEN contains(lower(c.context_id), 'current') THEN 60 ELSE 0 END)
    + (CASE WHEN contains(lower(c.context_id), 'nonconsolidated') THEN -25 WHEN contains(lower(c.context_id), 'consolidated') THEN 40 ELSE 0 END)
    + (CASE WHEN contains(lower(c.context_id), 'prior') THEN -80 ELSE 0 END) AS priority
  FROM cleaned c JOIN b_contexts k USING (document_id, context_id) WHERE regexp_matches(x, '^[+-]?[0-9]+(\.[0-9]+)?$')),
best AS (SELECT ticker, document_id, period_end, canonical AS concept, value, priority FROM num
  QUALIFY row_number() OVER (PARTITION BY document_id, period_end, canonical ORDER BY priority DESC, seq DESC, value DESC) = 1)"""

_PIVOT = ", ".join(f"max(CASE WHEN concept = '{c}' THEN value END) AS {c}" for c in FACT_FIELDS)
S_PERIODS = S_FACTS + f""",
heads AS (SELECT ticker, document_id, period_end, CASE WHEN count(DISTINCT period_type) > 1 THEN 'mixed' ELSE min(period_type) END AS period_type,
    CAST(arg_min(start_date, seq) FILTER (WHERE start_date IS NOT NULL) AS DATE) AS period_start FROM num GROUP BY ALL),
ctx AS (SELECT document_id, period_end, string_agg(context_id, ',' ORDER BY s) AS contexts FROM
   (SELECT document_id, period_end, context_id, min(seq) AS s FROM num GROUP BY ALL) GROUP BY ALL),
wide AS (SELECT document_id, period_end, {_PIVOT} FROM best GROUP BY ALL),
periods AS (SELECT h.ticker, h.document_id, h.period_end, h.period_type, h.period_start, CAST(year(h.period_end) AS INTEGER) AS fiscal_year, c.contexts, {", ".join(FACT_FIELDS)}
   FROM heads h JOIN wide w USING (document_id, period_end) JOIN ctx c USING (document_id, period_end))"""

_ASSETS = "coalesce(total_assets, current_assets + noncurrent_assets)"
_REST = ", ".join(f for f in FACT_FIELDS if f not in ("total_assets", "total_liabilities"))
S_TOTALS = S_PERIODS + f""",
totals AS (SELECT ticker, document_id, period_end, period_type, period_start, fiscal_year, contexts, {_REST}, {_ASSETS} AS total_assets,
    coalesce(total_liabilities, current_liabilities + noncurrent_liabilities, {_ASSETS} - net_assets) AS total_liabilities,
    operating_cf + investing_cf AS free_cash_flow,
    concat_ws(',', CASE WHEN operating_cf + investing_cf IS NOT NULL THEN 'free_cash_flow' END,
      CASE WHEN total_assets IS NULL AND {_ASSETS} IS NOT NULL THEN 'total_assets' END,
      CASE WHEN total_liabilities IS NULL AND coalesce(current_liabilities + noncurrent_liabilities, {_ASSETS} - net_assets) IS NOT NULL THEN 'total_liabilities' END) AS calculated
    FROM periods)"""


@query("j12_fact_context", DEPS, f"""WITH {S_FACTS}
SELECT document_id, context_id, canonical AS concept, period_end, CAST(priority AS INTEGER) AS priority, CAST(max(seq) AS BIGINT) AS seq,
  arg_max(value, (seq, value)) AS value FROM num GROUP BY ALL""")
def j12(t):
    return O.context_facts(t.b_facts, t.b_contexts).select(
        "document_id", "context_id", "concept", "period_end", "priority", "seq", "value"
    )


@query("a1_resolve_facts", DEPS, f"""WITH {S_FACTS}
SELECT ticker, document_id, period_end, concept, value, CAST(priority AS INTEGER) AS priority FROM best""")
def a1(t):
    return O.resolve_facts(t.b_facts, t.b_contexts)


@query("a2_period_rows", DEPS, f"WITH {S_PERIODS} SELECT * FROM periods")
def a2(t):
    rows = O.period_rows(t.b_facts, t.b_contexts)
    return rows.withColumn("contexts", F.concat_ws(",", "source_context_ids")).drop("source_context_ids")


@query("a3_derive_totals", DEPS, f"WITH {S_TOTALS} SELECT * FROM totals")
def a3(t):
    rows = O.derive_totals(O.period_rows(t.b_facts, t.b_contexts))
    return rows.select(
        "*", F.concat_ws(",", "source_context_ids").alias("contexts"), F.concat_ws(",", "calculated_fields").alias("calculated")
    ).drop("source_context_ids", "calculated_fields")


_FIRSTS = ", ".join(f"arg_min({f}, document_id) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in ALL_FIELDS)


@query("a4_period_index", DEPS, f"""WITH {S_TOTALS},
opening AS (SELECT ticker, period_end, period_start, period_type, fiscal_year FROM totals QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY document_id) = 1),
firsts AS (SELECT ticker, period_end, {_FIRSTS}, string_agg(document_id, ',' ORDER BY document_id) AS documents FROM totals GROUP BY ticker, period_end),
calc AS (SELECT ticker, period_end, string_agg(f, ',' ORDER BY f) AS calculated FROM
   (SELECT DISTINCT ticker, period_end, unnest(string_split(calculated, ',')) AS f FROM totals WHERE calculated <> '') GROUP BY ALL)
SELECT o.*, firsts.* EXCLUDE (ticker, period_end), coalesce(calc.calculated, '') AS calculated
FROM opening o JOIN firsts USING (ticker, period_end) LEFT JOIN calc USING (ticker, period_end)""")
def a4(t):
    index = O.period_index(O.derive_totals(O.period_rows(t.b_facts, t.b_contexts)))
    return index.select(
        "*", F.concat_ws(",", "source_document_ids").alias("documents"), F.concat_ws(",", "calculated_fields").alias("calculated")
    ).drop("source_document_ids", "calculated_fields")


@query("a4_period_documents", DEPS, f"WITH {S_TOTALS} SELECT DISTINCT ticker, period_end, document_id FROM totals")
def a4_documents(t):
    return O.period_documents(O.period_rows(t.b_facts, t.b_contexts))


@query("j13_filer_names", DEPS, rf"""
SELECT document_id, arg_min(name, (seq, name)) AS company_name FROM (
  SELECT f.document_id, f.seq, {s_strip('f.text')} AS name FROM b_facts f JOIN b_contexts USING (document_id, context_id)
  WHERE regexp_replace(lower(f.concept), '[^0-9a-z]+', '', 'g') IN ('filernameinjapanesedei')) WHERE name <> '' GROUP BY document_id""")
def j13_names(t):
    return O.company_names(t.b_facts, t.b_contexts)


@query("a5_latest_corrections", ["b_filings"], """
WITH f AS (SELECT edinetCode AS ticker, seq, docID, CASE WHEN seq % 10 = 0 THEN docID || '.zip' ELSE
   'jpcrp' || formCode || '-asr-001_' || edinetCode || '-000_' || period_end || '_0' || (1 + seq % 3) || '_' || list_date || '.xbrl' END AS member FROM b_filings),
p AS (SELECT *, regexp_extract(member, '_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{2})_[0-9]{4}-[0-9]{2}-[0-9]{2}\\.xbrl$', 1) AS pe,
   TRY_CAST(regexp_extract(member, '_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{2})_[0-9]{4}-[0-9]{2}-[0-9]{2}\\.xbrl$', 2) AS INTEGER) AS version,
   split_part(member, '_', 1) || split_part(member, '_', 2) AS prefix FROM f)
SELECT ticker, seq, docID, member FROM p WHERE version IS NULL
UNION ALL SELECT ticker, seq, docID, member FROM (SELECT * FROM p WHERE version IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ticker, prefix, pe ORDER BY version DESC, seq) = 1)""")
def a5(t):
    c = F.col
    member = F.when(c("seq") % 10 == 0, F.concat(c("docID"), F.lit(".zip"))).otherwise(
        F.concat(
            F.lit("jpcrp"), c("formCode"), F.lit("-asr-001_"), c("edinetCode"), F.lit("-000_"),
            c("period_end").cast("string"), F.lit("_0"), (c("seq") % 3 + 1).cast("string"), F.lit("_"),
            c("list_date").cast("string"), F.lit(".xbrl"),
        )
    )
    files = t.b_filings.select(c("edinetCode").alias("ticker"), "seq", "docID", member.alias("member"))
    return O.latest_corrections(files)

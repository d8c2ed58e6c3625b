"""Registered queries of the text operators and their DuckDB equivalents."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    chat_format, decontamination, license_scan, line_dedup, minhash, mixing, prefix_trie, quality_rules, secrets, spelling, token_counts, toxicity, url_filter,
)
from ledgerloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return register


def vocabulary_path() -> str:
    """The tokenizer file: a setting of the environment, else where the installed package keeps it."""
    if place := os.environ.get("LEDGERLOOM_VOCABULARY"):
        return place
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.known_urls(spark))


def _mixing_sql() -> str:
    """Water-filling, then each round of the fractional repetition as two tables: running sums, and what is taken of them."""
    rounds = []
    for k in range(1, mixing.ROUNDS + 1):
        before = "t0" if k == 1 else f"t{k - 1}"
        rounds.append(rf"""
s{k} AS (SELECT u.source, pos, size, room, sum(words) OVER (PARTITION BY u.source ORDER BY pos) AS upto FROM u JOIN {before} b ON u.source IS NOT DISTINCT FROM b.source
  WHERE size > 0 AND pos > after AND size <= room),
g{k} AS (SELECT source, max(pos) AS last, max(upto) AS words FROM s{k} WHERE upto <= room GROUP BY source),
t{k} AS (SELECT b.source, (room - coalesce(words, 0))::BIGINT AS room, coalesce(last, after) AS after FROM {before} b LEFT JOIN g{k} g ON b.source IS NOT DISTINCT FROM g.source)""")
    chosen = " UNION ALL ".join(f"SELECT source, pos, size FROM s{k} WHERE upto <= room" for k in range(1, mixing.ROUNDS + 1))
    return rf"""
WITH c AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::BIGINT AS size FROM documents),
d AS (SELECT *, md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS pos FROM c),
u AS (SELECT source, pos, size, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
s AS (SELECT source, sum(words)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM u GROUP BY source),
w AS (SELECT *, [3, 1, 2][place % 3 + 1]::BIGINT AS weight, source_size * 2 AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER before, 0)::BIGINT AS cb, coalesce(sum(weight) OVER before, 0)::BIGINT AS wb,
             (sum(source_size) OVER ())::BIGINT AS al, (sum(weight) OVER ())::BIGINT AS aw FROM w
      WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, al * 3 - cb * 2 AS lft, (aw - wb) * 2 AS ow FROM r),
lev AS (SELECT lft, ow FROM l WHERE weight * lft <= cap * ow ORDER BY cap / weight, place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN lev.ow IS NULL OR weight * lev.lft > cap * lev.ow THEN cap::DOUBLE
             ELSE (weight * lev.lft)::DOUBLE / lev.ow::DOUBLE END AS target FROM l LEFT JOIN lev ON true),
v AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
t0 AS (SELECT source, floor(target - whole * source_size)::BIGINT AS room, '' AS after FROM v),{",".join(rounds)},
x AS ({chosen})
SELECT d.doc_id, d.size, v.source_size, v.target, whole * d.size + CASE WHEN x.pos IS NULL THEN 0 ELSE d.size END AS taken, whole,
       CASE WHEN x.pos IS NULL THEN 0 ELSE d.size END::BIGINT AS part
FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.pos = x.pos
"""


@query("op4_mixing", _mixing_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
twice AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM tri),
rep AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM twice WHERE n > 1) GROUP BY k),
li AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT k, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM li WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
             coalesce(ln.n, 0)::BIGINT AS n_lines, coalesce(ln.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (k) LEFT JOIN rep USING (k) LEFT JOIN ln USING (k)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
              + CASE WHEN 10 * n_upper > 4 * word_chars THEN 16 ELSE 0 END
              + CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""


@query("op5_quality_rules", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = quality_rules.passes("base")
    return rows.select("*", (~base).alias("base_failed"), (base & quality_rules.passes("v2")).alias("kept"))


def _ablations_sql() -> str:
    cases = ", ".join(
        f"('{p}', '{r}', {quality_rules.mask_of(rules)}, {quality_rules.mask_of((r,))})" for p, rules in quality_rules.POLICIES.items() for r in rules
    )
    return rf"""
SELECT policy, rule, count(*)::BIGINT AS n_docs, (count(*) FILTER (failed & mask = 0))::BIGINT AS n_kept,
       (count(*) FILTER (failed & mask & ~bit = 0))::BIGINT AS n_kept_without
FROM ({OP5_SQL}), (VALUES {cases}) AS c(policy, rule, mask, bit) GROUP BY policy, rule
"""


@query("quality_ablations", _ablations_sql())
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents")))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    scores = toxicity.score(docs, model)
    return scores.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS phrase
      FROM b, unnest(range(1, greatest(2, len(ws) - 8))) AS r(i) WHERE len(ws) > 0),
lens AS (SELECT DISTINCT n FROM g),
s AS (SELECT k, n, i, array_to_string(ws[i : i + n - 1], ' ') AS phrase FROM d, lens, unnest(range(1, len(ws) - n + 2)) AS r(i)),
m AS (SELECT k, i, s.n, item_id FROM s JOIN g ON s.phrase = g.phrase AND s.n = g.n),
h AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM m) GROUP BY k),
t AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM m) GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""


@query("op6_decontamination", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.report(found)


@query("op6_proximity")
def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.proximity_report(found)


@query("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), least_words=line_dedup.EVERY_LINE)


@query("op10_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


# The conversation that the contract adds.
ADDED_TURNS = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))

OP3_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(a, b, c, d)),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS no,
             length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '(<\\*(?:\|turn\||\|text\||\|end\||\|im_start\||\|im_end\||\|endoftext\||\|system\||\|user\||\|assistant\||s|/s|<SYS>|</SYS>)>)|(\[\\*/?INST\])'))
               + length('<|turn|><|text|><|end|>') AS f,
             len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}\x{0B}\x{85}\x{2028}\x{2029}]')) + 4 AS tokens FROM c),
p AS (SELECT *, sum(tokens) OVER w - tokens AS bef, first(role) OVER w = 'system' AS sys, first(f) OVER w AS sf, first(tokens) OVER w AS st
      FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, greatest(1, 384 - CASE WHEN sys THEN st ELSE 0 END) AS step FROM p),
s AS (SELECT *, CASE WHEN bef // step = (bef + tokens - 1) // step THEN 2 * (bef // step) ELSE 2 * (bef // step) + 1 END AS span FROM q),
h AS (SELECT conv_id, span, min(no) AS no, min(bef) AS bef, any_value(sys) AS sys, any_value(sf) AS sf FROM s GROUP BY conv_id, span),
r AS (SELECT h.conv_id, h.span, sum(s.f) AS f FROM h JOIN s ON h.conv_id = s.conv_id AND s.no < h.no AND s.bef >= h.bef - 128
        AND NOT (h.sys AND s.no = 1) GROUP BY ALL),
x AS (SELECT h.conv_id, sum(coalesce(r.f, 0) + CASE WHEN sys AND no > 1 THEN sf ELSE 0 END) AS f FROM h LEFT JOIN r USING (conv_id, span) GROUP BY 1)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY no), '')) AS loss_sha256,
       (sum(s.f) + any_value(x.f))::BIGINT AS formatted_chars
FROM s JOIN x USING (conv_id) GROUP BY conv_id
"""


@query("op3_chat_format", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = F.explode(F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(row, turns.columns))) for row in ADDED_TURNS)))
    extra = spark.range(1).select(added.alias("t")).select("t.*")
    return chat_format.digests(chat_format.windows(turns.unionByName(extra)))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
pat AS (SELECT * FROM (VALUES
  (0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'), (1, 'AKIA[A-Z0-9]{16,}'), (2, '[0-9a-f]{24,}'), (3, '[A-Za-z0-9+/_=-]{20,}')) AS v(kind, p)),
raw AS (SELECT k, kind, p, regexp_extract_all(text, p) AS ms, string_split_regex(text, p) AS gaps FROM d, pat),
flat AS (SELECT k, kind, p, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gaps[1 : len(ms)]) AS g FROM raw WHERE len(ms) > 0),
each AS (SELECT k, kind, p, m, sum(length(g)) OVER w + coalesce(sum(length(m)) OVER b, 0) AS s FROM flat
         WINDOW w AS (PARTITION BY k, kind ORDER BY i), b AS (PARTITION BY k, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
base AS (SELECT k, kind, s, s + length(m) AS e FROM each
         WHERE CASE kind WHEN 0 THEN length(regexp_extract(m, p, 2)) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24 END),
runs AS (SELECT k, s, m, CASE WHEN regexp_matches(m, '^[0-9a-fA-F]*$') THEN 2.9 ELSE 3.6 END AS least FROM each x
         WHERE kind = 3 AND length(m) >= 20 AND NOT regexp_matches(m, '(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|example|x{8}|0{8}|12345678|abcdefgh|^[0-9/_=+-]*$|^[A-Za-z/_=+-]*$')
         AND NOT EXISTS (SELECT 1 FROM base b WHERE b.k = x.k AND b.s < x.s + length(x.m) AND x.s < b.e)),
win AS (SELECT k, s, least, o, unnest(string_split(substr(m, o + 1, 20), '')) AS ch FROM runs, unnest(range(0, length(m) - 19)) AS r(o)),
cnt AS (SELECT k, s, least, o, ch, count(*) AS c FROM win GROUP BY ALL),
ent AS (SELECT k, s, least, o, log2(20) - sum(c * log2(c)) / 20 AS h FROM cnt GROUP BY k, s, least, o),
hot AS (SELECT k, 3 AS kind, s + min(o) AS s, s + max(o) + 20 AS e FROM ent WHERE h >= least GROUP BY k, s),
allspans AS (SELECT k, kind, s, e, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS t
             FROM (SELECT * FROM base UNION ALL SELECT * FROM hot)),
agg AS (SELECT k, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
               string_agg(t, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY s, kind) AS spans FROM allspans GROUP BY k)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN agg USING (k)
"""


@query("op7_secret_scan", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


# CRC-32 by the table of its polynomial, since the SQL dialect has no such function.
CRC_SQL = """
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([i::BIGINT] || list_transform(range(8), lambda x: x::BIGINT),
         lambda c, x: xor(c >> 1, (c & 1) * 3988292384::BIGINT)) AS v FROM range(256) AS r(i)))"""


def _crc(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)"


OP11_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 5 GROUP BY ALL),
marked AS (SELECT run, k, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")}::BIGINT AS h FROM runs, crc_table),
made AS (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM marked),
w AS (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM w, unnest(range(1, length(word) + 1)) AS r(i)),
near AS (SELECT x.word, y.word AS other, y.n AS m FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND length(x.word) = length(y.word) AND x.word <> y.word
         UNION SELECT x.word, y.word, y.n FROM cut x JOIN w y ON x.a || x.b = y.word
         UNION SELECT y.word, x.word, x.n FROM cut x JOIN w y ON x.a || x.b = y.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(l := -m, o := other)) AS b FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.l >= 2 * n THEN b.o END AS form,
             CASE WHEN -b.l >= 2 * n THEN -b.l END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS up FROM f UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON f.word = c.up)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN chain c ON c.word = f.word AND c.up IS NULL
"""


@query("op11_spelling_variants", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH {CRC_SQL},
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r)::VARCHAR || ':' || r || x)) AS pos, r, x
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, ({_crc("conv_id::VARCHAR")} % 6)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM t), crc_table),
p AS (SELECT c.conv_id, pos, r, x FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
      UNION ALL SELECT c.conv_id, 5 + pos, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS d, length(x) AS len, md5(length(r)::VARCHAR || ':' || r || x) AS m FROM p),
path AS (SELECT conv_id, d, len, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS node FROM q
         UNION ALL SELECT conv_id, 0, 0, '' FROM c),
last AS (SELECT conv_id, max_by(node, d) AS node FROM path GROUP BY conv_id),
ends AS (SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha, count(*) AS n_ends FROM last GROUP BY node),
n AS (SELECT node, any_value(d) AS depth, any_value(len) AS len, count(*) AS n_convs, min(conv_id) AS conv_id FROM path GROUP BY node),
k AS (SELECT left(node, length(node) - 32) AS up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.up = n.node),
above AS (SELECT left(node, 32 * i) AS top, (n_convs - 1) * len AS weight, n_children = 0 AS leaf FROM m, unnest(range(0, depth + 1)) AS r(i)),
s AS (SELECT top, sum(weight)::BIGINT AS saved_tokens, (count(*) FILTER (leaf))::BIGINT AS n_leaves FROM above GROUP BY top)
SELECT m.conv_id, m.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, n_leaves, saved_tokens,
       coalesce(sha, sha256('')) AS ends_sha256, coalesce(n_ends, 0)::BIGINT AS n_ends
FROM m JOIN s ON s.top = m.node LEFT JOIN n up ON m.depth > 0 AND up.node = left(m.node, length(m.node) - 32) LEFT JOIN ends e ON e.node = m.node
"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns))


def _license_sql() -> str:
    every = (*license_scan.PHRASES, *license_scan.TEMPLATES)
    found = ", ".join(f"CASE WHEN regexp_matches(j, '{license_scan.as_pattern(m)}') THEN '{label}' END" for label, m in every)
    places = " || ".join(
        "list_filter(range(1, len(ws) + 1), lambda i: " + " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split())) + ")"
        for _, phrase in license_scan.PHRASES
    )
    n = len(license_scan.PHRASES)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
j AS (SELECT *, ' ' || array_to_string(ws, ' ') || ' ' AS j FROM d),
p AS (SELECT doc_id, ws, {places} AS places, [{found}] AS f FROM j),
q AS (SELECT *, list_sort(list_filter(f, lambda x: x IS NOT NULL)) AS l, list_sort(list_filter(f[1:{n}], lambda x: x IS NOT NULL)) AS b FROM p)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(places)::BIGINT AS n_base, (list_min(places) - 1)::BIGINT AS first_word, (list_max(places) - 1)::BIGINT AS last_word,
       array_to_string(b, ',') AS base_labels, array_to_string(l, ',') AS labels,
       CASE WHEN len(l) = 0 THEN 0.0 WHEN len(l) = len(b) THEN 0.5 ELSE 1.0 END::DOUBLE AS score FROM q
"""


@query("op13_license_scan", _license_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")

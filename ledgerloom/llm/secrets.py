"""Secret scans: named patterns, and sliding-window Shannon entropy over candidate strings.

Patterns of three kinds are found leftmost and without overlap per kind, too short ones dropped. Besides, runs of key-like
characters are candidates: a window slides over them with incremental character counts, and where its entropy reaches the
threshold of the run's character class the windows' stretch is a span of kind ``entropy``. Runs on the allow list and runs that
touch a pattern's span are left out.

Spans are code points, end exclusive, of the whole text; positions are running sums in blocks and runs look their neighbours up by
halving, so a text of very many matches takes time nearly in proportion. A missing text is empty and has no spans. Repeated rows are scanned
each. Only the id and the text are read; nothing is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import let

# Kinds in order, patterns and least lengths.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORD = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters and more
HEX = r"[0-9a-f]{24,}"
# Candidates of the entropy scan: whole runs of key characters.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
# Least entropy in bits by character class of the run: hexadecimal digits only, or letters of any kind with digits.
LEAST_HEX, LEAST_MIXED = 2.9, 3.6
# Runs that are no secrets: identifiers with dashes, documentation keys, filler, plain numbers or words.
ALLOWED = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|example|x{8}|0{8}|12345678|abcdefgh|^[0-9/_=+-]*$|^[A-Za-z/_=+-]*$"
FIRST_CODE, CODES = 43, 80  # code points of the run's characters: + to z
# Matches in one block of running sums.
BLOCK = 64


def _ends(lengths: Column) -> Column:
    """Running sums of an array. They are made within blocks and then moved by the sums of the blocks before, since a sum over the
    whole array would copy it at every element."""
    block = F.lit(BLOCK)
    none = F.array().cast("array<int>")

    def running(values):
        last = lambda s: F.coalesce(F.get(s, F.size(s) - 1), F.lit(0))
        return F.aggregate(values, none, lambda s, x: F.concat(s, F.array(last(s) + x)))

    def blocks(values):
        firsts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), block), lambda i: i < F.size(values))
        return F.transform(firsts, lambda i: running(F.slice(values, i + 1, block)))

    def moved(sums):
        def shifted(before):
            return F.flatten(F.transform(sums, lambda own, k: let(
                F.when(k > 0, F.get(before, k - 1)).otherwise(0), lambda by: F.transform(own, lambda x: x + by)
            )))

        return let(running(F.transform(sums, F.array_max)), shifted)

    return let(let(lengths, blocks), moved)


def located(text: Column, pattern: str, gate: Column) -> Column:
    """Array of (start, m) of all matches; the pieces between matches give the positions. Texts outside ``gate`` have none."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(found)).alias("gap"), found.alias("m"))
    none = F.array().cast("array<struct<start: int, m: string>>")

    def placed(pairs):
        ends = _ends(F.transform(pairs, lambda p: F.char_length(p["gap"]) + F.char_length(p["m"])))
        return let(ends, lambda e: F.transform(
            pairs, lambda p, i: F.struct((F.get(e, i) - F.char_length(p["m"])).alias("start"), p["m"].alias("m"))
        ))

    return F.when(gate, let(pairs, placed)).otherwise(none)


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


def _to_span(kind: int):
    return lambda x: _span(kind, x["start"], x["start"] + F.char_length(x["m"]))


def base_groups(text: Column) -> Column:
    """Spans of the three patterns: one array per kind, each in order and without overlap."""
    assigned = F.filter(
        located(text, ASSIGN, text.rlike(ASSIGN_WORD)),
        lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST,
    )
    groups = (assigned, located(text, ACCESS, text.contains("AKIA")), located(text, HEX, text.rlike(HEX)))
    return F.array(*(F.transform(g, _to_span(i)) for i, g in enumerate(groups)))


def _touched(spans: Column, start: Column, end: Column) -> Column:
    """Whether a span of an ordered array without overlaps touches [start, end): the last one that begins before ``end`` tells,
    and halving finds it."""
    zero = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halve(state, _):
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        before = (state["low"] < state["high"]) & (F.get(spans, middle)["start"] < end)
        low = F.when(before, middle + 1).otherwise(state["low"])
        high = F.when(before | (state["low"] >= state["high"]), state["high"]).otherwise(middle)
        return F.struct(low.alias("low"), high.alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    last = F.aggregate(steps, zero, halve, lambda state: state["low"] - 1)
    return F.when(F.size(spans) == 0, False).otherwise(F.coalesce(let(last, lambda i: F.get(spans, F.when(i >= 0, i))["end"] > start), F.lit(False)))


def hot_stretch(run: Column, least: Column) -> Column:
    """(low, high): the first and the last start of windows whose entropy is at least ``least``; low is -1 where none is.

    With counts c in a window of W characters the entropy is log2 W - sum(c log2 c) / W; a step forward changes the counts of
    two characters, and the sum by their four terms.
    """
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c) - FIRST_CODE)
    term = F.array(*(F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(WINDOW + 1)))
    zero = F.struct(
        F.array_repeat(F.lit(0), CODES).alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1).alias("low"), F.lit(-1).alias("high")
    )

    def step(state, i, code):
        new, old = F.get(code, i), F.when(i >= WINDOW, F.get(code, i - WINDOW)).otherwise(F.lit(-1))
        n_new, n_old = F.get(state["counts"], new), F.get(state["counts"], old)
        moved = F.when(new == old, state["sum"]).otherwise(
            state["sum"] + F.get(term, n_new + 1) - F.get(term, n_new) + F.when(old >= 0, F.get(term, n_old - 1) - F.get(term, n_old)).otherwise(0.0)
        )
        counts = F.transform(state["counts"], lambda c, k: c + (k == new).cast("int") - (k == old).cast("int"))
        hot = (i >= WINDOW - 1) & (math.log2(WINDOW) - moved / WINDOW >= least)
        at = i - (WINDOW - 1)
        return F.struct(
            counts.alias("counts"), moved.alias("sum"),
            F.when(hot & (state["low"] < 0), at).otherwise(state["low"]).alias("low"), F.when(hot, at).otherwise(state["high"]).alias("high"),
        )

    places = F.sequence(F.lit(0), F.char_length(run) - 1)
    return let(codes, lambda c: F.aggregate(places, zero, lambda s, i: step(s, i, c), lambda s: F.struct(s["low"], s["high"])))


def entropy_spans(text: Column, groups: Column) -> Column:
    runs = F.filter(located(text, RUN, text.rlike(RUN)), lambda x: ~x["m"].rlike(ALLOWED))
    clear = F.filter(runs, lambda x: ~F.exists(groups, lambda g: _touched(g, x["start"], x["start"] + F.char_length(x["m"]))))

    def judge(x):
        least = F.when(x["m"].rlike("^[0-9a-fA-F]*$"), F.lit(LEAST_HEX)).otherwise(F.lit(LEAST_MIXED))
        return F.struct(x["start"].alias("start"), hot_stretch(x["m"], least).alias("hot"))

    hot = F.filter(F.transform(clear, judge), lambda x: x["hot"]["low"] >= 0)
    return F.transform(hot, lambda x: _span(3, x["start"] + x["hot"]["low"], x["start"] + x["hot"]["high"] + WINDOW))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` and ``spans``: arrays of (start, kind, end) in order; ``spans`` has the entropy spans too."""
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    found = rows.select("id", "text", base_groups(F.col("text")).alias("groups"))
    more = found.select("id", F.flatten("groups").alias("base"), entropy_spans(F.col("text"), F.col("groups")).alias("more"))
    return more.select(
        F.col("id").alias(id_col), F.array_sort("base").alias("base"), F.array_sort(F.concat("base", "more")).alias("spans")
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    digest = F.sha2(written(F.col("base")).cast("binary"), 256)
    return found.select(id_col, *counts, digest.alias("base_sha256"), written(F.col("spans")).alias("spans"))

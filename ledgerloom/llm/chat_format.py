"""Chat formatting into budgeted windows.

A turn is ``<|turn|>role<|text|>text<|end|>``. Control strings inside a role or a text are escaped by one more backslash after
their first character, and read back by taking one away, so any text comes back as it was.

Turn tokens are summed along the conversation. The budget for a window's own turns is what system turn and history leave; sums
are cut at multiples of it: turns wholly between two cuts share a window, a turn across a cut has its own. So windows hold
whole turns and stay inside the budget, but for a single turn that is longer. Each window repeats the system turn (a
first turn of role ``system``) and then as many whole turns before it as fit the history budget. The loss mask covers the texts of
assistant turns where they are new; whatever is repeated is masked.

Turns are ordered by turn number, then role and text; missing texts and roles are empty. Repeated rows are turns of their own.
Rows without a conversation id form one conversation. An empty table gives no windows. Very long texts stay whole.
Windows are built from sorted turns of one conversation; a conversation is a unit of training and is never split by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The template's marks and the control strings of common templates, each as first character and rest.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (
    "<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
)
BUDGET = 512
HISTORY = 128

_RESTS = "|".join(r"\Q" + c[1:] + r"\E" for c in CONTROL if c[0] == "<"), "|".join(r"\Q" + c[1:] + r"\E" for c in CONTROL if c[0] == "[")
_CONTROL = rf"(?:(<)(\\*)(?={_RESTS[0]})|(\[)(\\*)(?={_RESTS[1]}))"
_ESCAPED = rf"(?:(<)\\(\\*)(?={_RESTS[0]})|(\[)\\(\\*)(?={_RESTS[1]}))"
# Tokens for the budget: runs of letters and digits, and every other sign.
PIECE = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$3$2$4")


def formatted_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns in order with their formatted text, tokens and the sum of tokens before them."""
    raw = turns.select(
        turns[conv_col].alias("conv"), turns[turn_col].alias("turn"),
        F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"), F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    each = raw.select(
        "conv", "turn", "role", "text", F.char_length(head).alias("head"), F.char_length(body).alias("body"),
        F.concat(head, body, F.lit(END)).alias("f"), (F.regexp_count("text", F.lit(PIECE)) + 4).cast("bigint").alias("tokens"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = each.select("*", F.row_number().over(order).alias("no"))
    # The running sum is ordered by the place, so equal turns are told apart.
    running = F.sum("tokens").over(Window.partitionBy("conv").orderBy("no").rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("*", (running - F.col("tokens")).alias("before"))


def windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv, window, first, n_repeated, n_turns, tokens, formatted, loss): one row per window.

    ``first`` is the place of the window's first own turn, ``n_repeated`` the turns repeated before it, ``loss`` the spans
    (start, size) of the formatted text that are learnt, in code points. One shuffle, by conversation.
    """
    placed = formatted_turns(turns, conv_col, turn_col, role_col, text_col)
    inside = Window.partitionBy("conv").orderBy("no")
    is_system = (F.first("role").over(inside) == "system").alias("has_system")
    unit = F.struct("no", "role", "head", "body", "f", "tokens")
    first_turn = F.first(unit).over(inside)
    step = F.greatest(F.lit(1), F.lit(budget - history) - F.when(is_system, F.first("tokens").over(inside)).otherwise(0))
    marked = placed.select("*", is_system, F.when(is_system, first_turn).alias("system"), step.cast("bigint").alias("step"))
    low, high = F.floor(F.col("before") / F.col("step")), F.floor((F.col("before") + F.col("tokens") - 1) / F.col("step"))
    cut = marked.withColumn("span", F.when(low == high, 2 * low).otherwise(2 * low + 1))
    # Turns before this one, as far back as the history budget reaches, by the sums of tokens.
    recent = F.collect_list(unit).over(Window.partitionBy("conv").orderBy("before").rangeBetween(-history, 0))
    new_span = F.coalesce(F.lag("span").over(inside) != F.col("span"), F.lit(True))
    told = cut.withColumn("recent", F.when(new_span, F.filter(recent, lambda t: (t["no"] < F.col("no")) & ~(F.col("has_system") & (t["no"] == 1)))))
    own = F.sort_array(F.collect_list(unit))
    rows = told.groupBy("conv", "span").agg(own.alias("own"), F.max("system").alias("system"), F.first("recent", True).alias("recent"))
    none = F.slice("own", F.lit(1), F.lit(0))
    kept_system = F.when(F.col("system").isNotNull() & (F.col("own")[0]["no"] > 1), F.array("system")).otherwise(none)
    before = F.concat(kept_system, F.coalesce(F.array_sort("recent"), none))
    rows = rows.select("conv", "own", before.alias("repeated"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, size: int>>").alias("loss"))

    def walk(state, t):
        span = F.struct((state["at"] + t["head"]).alias("start"), t["body"].alias("size"))
        learnt = F.when(t["role"] == "assistant", F.concat(state["loss"], F.array(span))).otherwise(state["loss"])
        return F.struct((state["at"] + F.char_length(t["f"])).alias("at"), learnt.alias("loss"))

    texts = lambda c: F.array_join(F.transform(c, lambda t: t["f"]), "")
    start = F.struct(F.char_length(texts("repeated")).alias("at"), zero["loss"].alias("loss"))
    count = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, t: s + t["tokens"])
    return rows.select(
        "conv", F.col("own")[0]["no"].alias("first"), F.size("repeated").alias("n_repeated"), F.size("own").alias("n_turns"),
        (count("repeated") + count("own")).alias("tokens"),
        F.concat(texts("repeated"), texts("own")).alias("formatted"), F.aggregate("own", start, walk, lambda s: s["loss"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text, unescaped. Marks occur nowhere else, since those in texts are escaped."""
    parts = F.filter(F.split(formatted, r"\Q" + TURN + r"\E"), lambda p: p != "")

    def one(part):
        role = F.split_part(part, F.lit(TEXT), F.lit(1))
        text = F.substring(part, F.char_length(role) + len(TEXT) + 1, F.char_length(part) - F.char_length(role) - len(TEXT) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, one)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The learnt texts of a window, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["size"])))


def digests(wins: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the windows: turns, their digest, the learnt text's length and digest, formatted length.

    A digest is over the whole conversation, so its texts meet in one row.
    """
    read = wins.select(
        "conv", "first", F.char_length("formatted").alias("chars"),
        F.slice(read_turns(F.col("formatted")), F.col("n_repeated") + 1, F.col("n_turns")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learnt"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = read.select("conv", "chars", F.size("turns").alias("n"), F.struct("first", lines.alias("lines"), "learnt").alias("w"))
    whole = each.groupBy("conv").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sort_array(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    texts = whole.select("conv", "n", "chars", joined("lines").alias("lines"), joined("learnt").alias("learnt"))
    return texts.select(
        F.col("conv").alias(conv_col), F.col("n").cast("bigint").alias("n_turns"), sha(F.col("lines")).alias("turns_sha256"),
        F.char_length("learnt").cast("bigint").alias("loss_chars"), sha(F.col("learnt")).alias("loss_sha256"),
        F.col("chars").cast("bigint").alias("formatted_chars"),
    )

"""Column expressions that read numbers from the notations of filings, statements and web pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Strings that mean "no value" in each kind of source.
WEB_NULLS = ("---", "--", "N/A", "NA", "n/a", "", "-", "－", "—")
CELL_NULLS = ("", "-", "－", "―", "—", "−", "–")
SITE_NULLS = ("", "---", "－", "—", "N/A")
CAP_NULLS = ("", "---", "－")

# Money unit words and their multipliers, in the order they are read.
UNIT_WORDS = (("兆", 1e12), ("億", 1e8), ("百万", 1e6), ("万", 1e4))

FLOAT_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_SHAPE = r"^[+-]?[0-9]+$"

# One group per unit word: the digits before the first 兆, then 億, 百万, 万, then the rest.
_UNIT_PARTS = r"^(?:([^兆]*)兆)?(?:([^億]*)億)?(?:(.*?)百万)?(?:([^万]*)万)?(.*)$"


_BLANKS = " \t\n\r\x0b\x0c\u3000\u00a0"


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (`trim` alone removes blanks only)."""
    return F.btrim(c, F.lit(_BLANKS))


def to_double(c: Column) -> Column:
    """Double when the text has a plain number shape, else null."""
    return F.when(c.rlike(FLOAT_SHAPE), c.try_cast("double"))


def _no_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row and bound to a name.

    Long text expressions that use an intermediate value many times would otherwise be copied at every
    use, beyond what code generation accepts.
    """
    return F.transform(F.array(value), body).getItem(0)


def parse_jp_number(text: Column) -> Column:
    """Number with Japanese units, signs and suffixes: `1兆2,345億円`, `△1,234`, `13.58倍`."""
    sign = "^[△▲\\-−ー]"
    suffix = "[%％倍円株]$"

    def with_units(parts: Column) -> Column:
        words = [parts.getItem(i) for i in range(4)]
        malformed = reduce(lambda a, b: a | b, [(p != "") & ~p.rlike(FLOAT_SHAPE) for p in words])
        amounts = [F.coalesce(to_double(p) * F.lit(m), F.lit(0.0)) for p, (_, m) in zip(words, UNIT_WORDS)]
        rest = F.coalesce(to_double(strip(F.regexp_replace(parts.getItem(4), suffix, ""))), F.lit(0.0))
        return F.when(~malformed, reduce(lambda a, b: a + b, amounts + [rest]))

    def value_of(body: Column) -> Column:
        parts = F.array(*[strip(_no_commas(F.regexp_extract(body, _UNIT_PARTS, i))) for i in range(1, 6)])
        return F.when(~body.rlike("[兆億万]"), to_double(_no_commas(body))).when(
            body != "", let(parts, with_units)
        )

    def signed(s: Column) -> Column:
        body = strip(F.regexp_replace(strip(F.regexp_replace(s, sign, "")), suffix, ""))
        return F.when(
            ~s.isin(*WEB_NULLS),
            F.when(s.rlike(sign), F.lit(-1.0)).otherwise(F.lit(1.0)) * let(body, value_of),
        )

    plain = _no_commas(text)
    # Most figures are plain; only the others need the unit words.
    return F.when(plain.rlike(FLOAT_SHAPE) & ~plain.startswith("-"), plain.try_cast("double")).otherwise(
        let(strip(text), signed)
    )


def parse_market_cap(text: Column) -> Column:
    """Sum of the 兆, 億 and 万 parts found anywhere; a plain number when there is none."""
    s = F.regexp_replace(strip(text), "[,  ]", "")
    total = F.lit(0.0)
    for word, mult in (UNIT_WORDS[0], UNIT_WORDS[1], UNIT_WORDS[3]):
        part = F.regexp_extract(s, rf"([0-9.]+){word}", 1)
        total = total + F.coalesce(to_double(part) * F.lit(mult), F.lit(0.0))
    plain = to_double(F.regexp_replace(s, "円$", ""))
    return F.when(~s.isin(*CAP_NULLS), F.when(total > 0, total).otherwise(plain))


def parse_plain_number(text: Column) -> Column:
    """Site table cell: commas, one trailing 倍/%/円, and ▲ or △ as a minus sign."""
    s = F.regexp_replace(strip(text), "[  ]", "")
    signed = F.translate(s, "▲△,", "--")
    return F.when(~s.isin(*SITE_NULLS), to_double(F.regexp_replace(signed, "[倍%円]$", "")))


def parse_statement_cell(raw: Column, multiplier: Column | int = 1) -> Column:
    """Financial table cell to a whole amount; parentheses and triangles mean negative."""
    s = strip(F.regexp_replace(strip(raw), r"※[０-９]*[,、]?\s*", ""))
    inner = F.when(s.rlike(r"^[（(]\s*.+?\s*[）)]$"), F.regexp_extract(s, r"^[（(]\s*(.+?)\s*[）)]$", 1)).otherwise(s)
    bare = F.regexp_replace(F.regexp_replace(inner, r"^[△▲]\s*", ""), "[－﹣−‐]", "-")
    negative = (inner != s) | inner.rlike("^[△▲]") | bare.rlike("^-")
    value = to_double(strip(_no_commas(F.regexp_replace(bare, "^-", ""))))
    signed = F.when(negative, -F.abs(value)).otherwise(value)
    scaled = signed * (multiplier if isinstance(multiplier, Column) else F.lit(multiplier))
    # A plain cast of a double to bigint truncates toward zero, as an integer conversion does.
    return F.when(~s.isin(*CELL_NULLS), scaled.cast("bigint"))


def coerce_number(text: Column) -> Column:
    """Lenient: commas and outer blanks are dropped, null words give null."""
    cleaned = strip(_no_commas(text))
    # None of the null words has the shape of a number, so the shape test covers them.
    return to_double(cleaned)


def coerce_nested_number(doc: Column, keys: tuple[str, ...] = ("value", "amount", "current", "fy")) -> Column:
    """Number from a VARIANT: itself when a number or text, else the first usable key; never a boolean."""
    def scalar(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        return F.when(kind.isin("BOOLEAN", "VOID"), F.lit(None).cast("double")).otherwise(
            coerce_number(F.try_variant_get(v, "$", "string"))
        )

    nested = [scalar(F.try_variant_get(doc, f"$.{k}", "variant")) for k in keys]
    return F.coalesce(F.when(~F.schema_of_variant(doc).startswith("OBJECT"), scalar(doc)), *nested)


def strict_integer(text: Column) -> Column:
    """Whole-number text only; decimals are refused so that money is never truncated."""
    cleaned = strip(_no_commas(text))
    return F.when(cleaned.rlike(INTEGER_SHAPE), cleaned.try_cast("bigint"))


def strict_float(text: Column) -> Column:
    """Finite number text only."""
    return coerce_number(text)


def xbrl_figure(text: Column) -> Column:
    """Number of a fact's text without commas and blanks, before its sign attribute."""
    # The number shape also refuses the empty text and every dash that stands for "no value".
    cleaned = F.translate(strip(text), ", ", "")
    return F.when(cleaned.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), cleaned.try_cast("double"))


def with_sign(value: Column, sign: Column) -> Column:
    """`sign = '-'` forces a negative value."""
    return F.when(sign == "-", -F.abs(value)).otherwise(value)


def parse_xbrl_number(text: Column, sign: Column) -> Column:
    """Fact text as a number, with its sign attribute."""
    return with_sign(xbrl_figure(text), sign)


def round2(c: Column) -> Column:
    """Two decimals, exact halves to the even digit."""
    return F.rint(c * 100.0) / 100.0


def round_to(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def ratio_percent(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double") * 100.0)


def growth_percent(current: Column, previous: Column) -> Column:
    cur, prev = current.cast("double"), previous.cast("double")
    return F.when(previous != 0, (cur - prev) / F.abs(prev) * 100.0)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def sum_nullable(first: Column, second: Column) -> Column:
    """Null only when both parts are null."""
    zero = F.lit(0)
    return F.when(
        first.isNotNull() | second.isNotNull(), F.coalesce(first, zero) + F.coalesce(second, zero)
    )


def non_null_count(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])

"""Column expressions for report cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels of period lengths and statement types.
PERIOD_LABELS = {3: "四半期", 6: "半期", 9: "3Q累計", 12: "通期"}
STATEMENT_LABELS = {"standalone": "単体", "consolidated": "連結"}
MONETARY_FIELDS = ("revenue", "operating_income", "net_income", "free_cash_flow")
NUMBER_SCALES = {"man_yen": (1_000_000.0, 0), "oku_yen": (100_000_000.0, 1)}


def fixed_decimals(value: Column, digits: int, grouped: bool = False) -> Column:
    """Text with a fixed number of decimals; exact halves go to the even digit, negative zero shows as zero."""
    scale = float(10**digits)
    rounded = F.rint(value * scale) / scale + F.lit(0.0)
    return F.format_string(f"%{',' if grouped else ''}.{digits}f", rounded)


def display_value(
    value: Column, number_format: str = "raw", monetary: bool = False, absent: Column | None = None, suffix: str = ""
) -> Column:
    """Report cell; nulls show as N/A, or as a dagger mark when the figure is known to be absent."""
    v = value.cast("double")
    if monetary and number_format in NUMBER_SCALES:
        unit, digits = NUMBER_SCALES[number_format]
        text = fixed_decimals(v / unit, digits, grouped=True)
    else:
        text = fixed_decimals(v, 2)
    missing = F.lit("N/A") if absent is None else F.when(absent, "—†").otherwise("N/A")
    return F.when(v.isNotNull(), F.concat(text, F.lit(suffix))).otherwise(missing)


def period_label(months: Column) -> Column:
    out = F.when(months.isNull(), "")
    for n, label in PERIOD_LABELS.items():
        out = out.when(months == n, label)
    return out.otherwise(F.concat(months.cast("string"), F.lit("M")))


def fiscal_year_display(fy: Column, months: Column) -> Column:
    label = period_label(months)
    year = F.coalesce(fy.cast("string"), F.lit("N/A"))
    return F.when(label.isin("", "通期"), year).otherwise(F.concat(year, F.lit(" ("), label, F.lit(")")))


def statement_label(kind: Column) -> Column:
    out = None
    for name, label in STATEMENT_LABELS.items():
        out = F.when(kind == name, label) if out is None else out.when(kind == name, label)
    return out.otherwise("-")


def shorten(text: Column, limit: int = 80) -> Column:
    flat = F.trim(F.replace(text, F.lit("\n"), F.lit(" ")))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit - 3), F.lit("..."))).otherwise(flat)

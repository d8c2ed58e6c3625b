"""Column expressions for period dates, fiscal years, quarters and filing kinds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.numbers import strip

# Year before the first year of each era.
ERA_OFFSETS = {"令和": 2018, "平成": 1988, "昭和": 1925}

HALF_YEAR_RULE_START = "2024-04-01"

_FULLWIDTH_DIGITS = ("０１２３４５６７８９", "0123456789")
_DATE = r"(?:([0-9]{4})\s*年|(令和|平成|昭和)\s*([0-9]{1,2})\s*年)\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
WESTERN_DATE = r"([0-9]{4})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
ERA_DATE = r"(令和|平成|昭和)\s*([0-9]{1,2})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"
START_DATE = r"自\s*" + _DATE
END_DATE = r"至\s*" + _DATE


def half_width(c: Column) -> Column:
    return F.translate(c, *_FULLWIDTH_DIGITS)


def era_offset(era: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ERA_OFFSETS.items() for x in pair])
    return F.try_element_at(table, era)


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a date given as digit strings; null when a part is missing."""
    pad = lambda c: F.lpad(c, 2, "0")
    return F.when(
        (year != "") & (month != "") & (day != ""), F.concat_ws("-", year, pad(month), pad(day))
    )


def _marked_date(c: Column, pattern: str) -> Column:
    group = lambda i: F.regexp_extract(c, pattern, i)
    year = F.when(group(1) != "", group(1)).otherwise(
        (era_offset(group(2)) + group(3).try_cast("int")).cast("string")
    )
    return iso_date(year, group(4), group(5))


def duration_start(text: Column) -> Column:
    return _marked_date(half_width(text), START_DATE)


def duration_end(text: Column) -> Column:
    return _marked_date(half_width(text), END_DATE)


def parse_jp_date(text: Column) -> Column:
    """First western date in the text, else first era date, as ISO text."""
    c = half_width(text)
    western = lambda i: F.regexp_extract(c, WESTERN_DATE, i)
    era = lambda i: F.regexp_extract(c, ERA_DATE, i)
    era_year = (era_offset(era(1)) + era(2).try_cast("int")).cast("string")
    return F.coalesce(
        iso_date(western(1), western(2), western(3)), iso_date(era_year, era(3), era(4))
    )


def column_header(text: Column) -> Column:
    """Struct (period_start, period_end, period_type, label) read from a table column header."""
    start, end, instant = duration_start(text), duration_end(text), parse_jp_date(text)
    both = start.isNotNull() & end.isNotNull()
    period_end = F.when(both, end).otherwise(instant)
    return F.when(
        period_end.isNotNull(),
        F.struct(
            F.when(both, start).alias("period_start"),
            period_end.alias("period_end"),
            F.when(both, "duration").otherwise("instant").alias("period_type"),
            F.when(F.contains(text, F.lit("前")), "prior").otherwise("current").alias("label"),
        ),
    )


def infer_period_end(text: Column) -> Column:
    """`2024-03`, `2024.03` or `2024/3` to the last day of that month."""
    s = strip(text)
    pattern = r"^([0-9]{4})[.\-/]([0-9]{1,2})"
    year = F.regexp_extract(s, pattern, 1).try_cast("int")
    month = F.regexp_extract(s, pattern, 2).try_cast("int")
    valid = month.between(1, 12) & year.between(1900, 2100)
    return F.when(valid, F.last_day(F.make_date(year, F.when(valid, month), F.lit(1))))


def is_forecast(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("予")), F.lit(False))


def fiscal_year(period_end: Column, fye_month: Column) -> Column:
    year = F.year(period_end)
    return F.when(F.month(period_end) <= fye_month, year).otherwise(year + 1)


def months_after_fye(period_end: Column, fye_month: Column) -> Column:
    return F.pmod(F.month(period_end) - fye_month, F.lit(12))


def quarter_label(period_end: Column, fye_month: Column) -> Column:
    offset = months_after_fye(period_end, fye_month)
    return (
        F.when(offset == 3, "Q1").when(offset == 6, "Q2").when(offset == 9, "Q3").when(offset == 0, "FY")
        .otherwise(F.concat(F.lit("M"), F.month(period_end).cast("string")))
    )


def period_kind(period_end: Column, period_start: Column, fye_month: Column) -> Column:
    """annual when the period ends in the fiscal month and is long or has no start."""
    long_enough = period_start.isNull() | (F.datediff(period_end, period_start) > 300)
    return F.when((F.month(period_end) == fye_month) & long_enough, "annual").otherwise("quarterly")


def filing_kind(period_end: Column, period_start: Column, fye_month: Column) -> Column:
    """annual, h1, q1, q2, q3 or unknown; half-year reports replace Q2 from April 2024."""
    days = F.datediff(period_end, period_start)
    offset = months_after_fye(period_end, fye_month)
    half_year = days.between(150, 200)
    new_rule = (period_start >= F.lit(HALF_YEAR_RULE_START).cast("date")) & half_year
    return (
        F.when((offset == 0) & (days.isNull() | (days > 300)), "annual")
        .when((offset == 0) & half_year, "h1")
        .when((offset == 6) & (new_rule | (days > 200)), "h1")
        .when(offset == 6, "q2")
        .when(offset == 3, "q1")
        .when(offset == 9, "q3")
        .otherwise("unknown")
    )


def fy_start(fy: Column, fye_month: Column) -> Column:
    return F.when(fye_month == 12, F.make_date(fy, F.lit(1), F.lit(1))).otherwise(
        F.make_date(fy - 1, F.when(fye_month < 12, fye_month + 1), F.lit(1))
    )


def quarter_start(fy: Column, fye_month: Column, quarter: Column) -> Column:
    offset = F.when(quarter == "q2", 3).when(quarter == "q3", 6).otherwise(0)
    return F.add_months(fy_start(fy, fye_month), offset)


def period_months(period_start: Column, period_end: Column) -> Column:
    """Whole months of the period, the end month included; null when not positive."""
    months = (
        (F.year(period_end) - F.year(period_start)) * 12 + F.month(period_end) - F.month(period_start) + 1
    )
    return F.when(months > 0, months)


def half_year_end(fiscal_year_end: Column) -> Column:
    return F.last_day(F.add_months(fiscal_year_end, -6))


def half_year_correction(period_end: Column, manifest_end: Column, doc_type: Column) -> Column:
    """Struct (period_end, period_end_original): half-year reports filed under the year end move back."""
    applies = F.coalesce((doc_type == "160") & (period_end == manifest_end), F.lit(False))
    return F.struct(
        F.when(applies, half_year_end(manifest_end)).otherwise(period_end).alias("period_end"),
        F.when(applies, period_end).alias("period_end_original"),
    )


def fye_month(text: Column) -> Column:
    """Month of a fiscal year end such as `3月31日`, `3月` or `03/31`."""
    first = F.regexp_extract(text, "([0-9]{1,2})月", 1)
    second = F.regexp_extract(text, "([0-9]{1,2})/[0-9]{1,2}", 1)
    return F.coalesce(first.try_cast("int"), second.try_cast("int"))


def in_fiscal_year(period_end: Column, fy: Column, fye: Column) -> Column:
    return fiscal_year(period_end, fye) == fy


def doc_type(code: Column, description: Column) -> Column:
    """Filing type code; half-year reports are known by their description when no code is given."""
    return F.coalesce(code, F.when(description.rlike("(?<!四)半期報告書"), "160"))

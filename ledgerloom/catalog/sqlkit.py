"""Fragments shared by the check SQL (DuckDB)."""

FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_RE = r"(?:([0-9]{4})\s*年|(令和|平成|昭和)\s*([0-9]{1,2})\s*年)\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s　 ]+|[\s　 ]+$', '', 'g')"


def s_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{FLOAT_RE}') THEN TRY_CAST({x} AS DOUBLE) END)"


def s_r2(x: str) -> str:
    return f"(round_even(({x}) * 1e2, 0) / 1e2)"


def s_ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a})::DOUBLE / ({b})::DOUBLE * 1e2 END)"


def s_growth(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN (({a})::DOUBLE - ({b})::DOUBLE) / abs(({b})::DOUBLE) * 1e2 END)"


def s_half(x: str) -> str:
    return f"translate({x}, '０１２３４５６７８９', '0123456789')"


def s_fy(d: str, fye: str) -> str:
    return f"CAST(CASE WHEN month({d}) <= {fye} THEN year({d}) ELSE year({d}) + 1 END AS INTEGER)"


def s_quarter(d: str, fye: str) -> str:
    return (
        f"(CASE (month({d}) - {fye} + 12) % 12 WHEN 3 THEN 'Q1' WHEN 6 THEN 'Q2' WHEN 9 THEN 'Q3' WHEN 0 THEN 'FY' "
        f"ELSE 'M' || month({d}) END)"
    )


def s_kind(end: str, start: str, fye: str) -> str:
    return (
        f"(CASE WHEN month({end}) = {fye} AND ({start} IS NULL OR date_diff('day', {start}, {end}) > 300) "
        f"THEN 'annual' ELSE 'quarterly' END)"
    )


def s_filing(end: str, start: str, fye: str) -> str:
    days = f"date_diff('day', {start}, {end})"
    off = f"((month({end}) - {fye} + 12) % 12)"
    return f"""(CASE WHEN {off} = 0 AND ({start} IS NULL OR {days} > 300) THEN 'annual'
      WHEN {off} = 0 AND {days} BETWEEN 150 AND 200 THEN 'h1'
      WHEN {off} = 6 AND {start} >= DATE '2024-04-01' AND {days} BETWEEN 150 AND 200 THEN 'h1'
      WHEN {off} = 6 AND {days} > 200 THEN 'h1' WHEN {off} = 6 THEN 'q2'
      WHEN {off} = 3 THEN 'q1' WHEN {off} = 9 THEN 'q3' ELSE 'unknown' END)"""

"""Column expressions over narrative text, page text, URLs and HTML."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ledgerloom.functions.dates import ERA_DATE, WESTERN_DATE, era_offset, half_width, iso_date
from ledgerloom.functions.numbers import let, strip
from ledgerloom.rules.lexicons import RISK_KEYWORDS, SEVERITY_HIGH, SEVERITY_LOW

_NUMBERED_LINE = r"(?<![^\n])[\s　]*(?:\(\p{Nd}+\)|\p{Nd}+[.)）]|[①-⑳])"

# Unit notations on statement pages, with multiplier and label, in order.
PAGE_UNITS = (
    (r"[（(]?\s*単位\s*[：:]\s*百万円\s*[）)]?|[（(]\s*百万円\s*[）)]", 1_000_000, "百万円"),
    (r"[（(]?\s*単位\s*[：:]\s*千円\s*[）)]?|[（(]\s*千円\s*[）)]", 1_000, "千円"),
    (r"[（(]?\s*単位\s*[：:]\s*円\s*[）)]?|[（(]\s*円\s*[）)]", 1, "円"),
)
DEFAULT_PAGE_UNIT = (1_000_000, "百万円（デフォルト）")
# Unit notations in table headers.
HEADER_UNITS = (("百万円", 1_000_000), ("千円", 1_000), ("（単位：円）|（円）", 1))
DEFAULT_HEADER_UNIT = 1_000

# Statement headings, consolidated before standalone.
_QI = "(?:四半期|中間)?"
STATEMENT_HEADINGS = (
    ("bs", f"【{_QI}連結貸借対照表】"),
    ("pl", f"【{_QI}連結損益計算書(?:及び{_QI}連結包括利益計算書)?】"),
    ("cf", f"【{_QI}連結キャッシュ・フロー計算書】"),
    ("bs", f"【{_QI}貸借対照表】"),
    ("pl", f"【{_QI}損益計算書(?:及び{_QI}包括利益計算書)?】"),
    ("cf", f"【{_QI}キャッシュ・フロー計算書】"),
)


def strip_html(c: Column) -> Column:
    no_tags = F.regexp_replace(c, "<[^>]+>", " ")
    return strip(F.regexp_replace(F.regexp_replace(no_tags, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def mask_sensitive(c: Column) -> Column:
    # Few texts hold an address or a secret: a plain search decides whether the pattern has to run.
    mails = F.when(
        F.contains(c, F.lit("@")), F.regexp_replace(c, r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", "***")
    ).otherwise(c)
    lower = F.lower(c)
    named = F.contains(lower, F.lit("password")) | F.contains(lower, F.lit("passwd")) | F.contains(lower, F.lit("secret")) | F.contains(lower, F.lit("token"))
    return F.when(
        named, F.regexp_replace(mails, r"(?i)(password|passwd|secret|token)\s*[:=]\s*\S+", "***")
    ).otherwise(mails)


def split_paragraphs(text: Column) -> Column:
    """Array of risk paragraphs: cut at numbered line starts, else at blank lines; 20 characters or more."""
    whole = strip(text)
    none = F.array().cast("array<string>")
    blocks = lambda numbered: F.when(F.size(numbered) > 1, numbered).otherwise(F.split(text, r"\n\n+"))
    chosen = lambda kept: F.when(F.size(kept) > 0, kept).when(whole != "", F.array(whole)).otherwise(none)
    parts = let(F.split(text, _NUMBERED_LINE), blocks)
    return let(F.filter(F.transform(parts, strip), lambda p: F.length(p) >= 20), chosen)


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def _decided(by_first: list[tuple[str, list[str]]]) -> str:
    """A pattern for words grouped by their first characters, in order: a range of characters decides which half is tried.

    A class of many characters, or many words side by side, would be tried one after the other at every place.
    """
    if len(by_first) == 1:
        return "(?:" + "|".join(_quoted(w) for w in sorted(by_first[0][1], key=len, reverse=True)) + ")"
    half = len(by_first) // 2
    first, last = by_first[0][0], by_first[half - 1][0]
    return f"(?:(?=[{_quoted(first)}-{_quoted(last)}]){_decided(by_first[:half])}|{_decided(by_first[half:])})"


def word_places(text: Column, words: list[str]) -> Column:
    """For every place of the text where a word begins, the longest such word; the text is passed over once.

    The look-ahead consumes nothing, so words inside other words are found; a place whose character lies outside the range of
    the words' first characters is left at once.
    """
    groups: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        groups.setdefault(w[0], []).append(w)
    by_first = sorted(groups.items())
    ascii_only = [c for c, _ in by_first if c.isascii()]
    others = [c for c, _ in by_first if not c.isascii()]
    guard = "".join(map(_quoted, ascii_only)) + (f"{others[0]}-{others[-1]}" if others else "")
    return F.regexp_extract_all(text, F.lit(f"(?=[{guard}])(?=({_decided(by_first)}))"), F.lit(1))


def _overlaps_itself(word: str) -> bool:
    return any(word.startswith(word[i:]) for i in range(1, len(word)))


def _count_of(places: Column, text: Column, words: list[str], every: list[str]) -> Column:
    """Number of non-overlapping occurrences of each of ``words``, summed, from the places of ``every`` word.

    A word that begins a longer one stands wherever that does. A word that can overlap itself is counted in the text.
    """
    plain = [w for w in words if not _overlaps_itself(w)]
    weights = {v: sum(v.startswith(w) for w in plain) for v in every}
    out = F.lit(0)
    for weight in sorted({k for k in weights.values() if k}):
        its = [v for v, k in weights.items() if k == weight]
        out = out + F.size(F.filter(places, lambda p: p.isin(*its))) * weight
    for w in words:
        if _overlaps_itself(w):
            out = out + ((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)).cast("int")
    return out


def _category(places: Column, text: Column, keywords: dict[str, list[str]], every: list[str]) -> Column:
    names = F.array(*[F.lit(k) for k in keywords])
    hits = F.array(*[_count_of(places, text, words, every) for words in keywords.values()])
    return let(
        hits,
        lambda h: F.when(F.array_max(h) == 0, F.lit("other_risk")).otherwise(
            F.element_at(names, F.array_position(h, F.array_max(h)).cast("int"))
        ),
    )


def _severity(places: Column, high: list[str], low: list[str], every: list[str]) -> Column:
    any_of = lambda words: F.exists(places, lambda p: p.isin(*[v for v in every if any(v.startswith(w) for w in words)]))
    return F.when(any_of(high), "high").when(any_of(low), "low").otherwise("medium")


def risk_judgement(
    text: Column, keywords: dict[str, list[str]] = RISK_KEYWORDS, high: list[str] = SEVERITY_HIGH, low: list[str] = SEVERITY_LOW
) -> Column:
    """Struct (category, severity) from one pass over the text.

    The category is the one with most keyword hits; the first listed wins ties; none is other_risk. Severity is high if any word of
    that list stands in the text, else low if one of the other, else medium. A missing text has neither.
    """
    every = sorted({w for words in [*keywords.values(), high, low] for w in words})
    judged = lambda p: F.struct(_category(p, text, keywords, every).alias("category"), _severity(p, high, low, every).alias("severity"))
    return let(word_places(text, every), lambda p: F.when(p.isNotNull(), judged(p)))


def risk_category(text: Column, keywords: dict[str, list[str]] = RISK_KEYWORDS) -> Column:
    """Category alone, see ``risk_judgement``."""
    every = sorted({w for words in keywords.values() for w in words})
    return let(word_places(text, every), lambda p: _category(p, text, keywords, every))


def risk_severity(text: Column, high: list[str] = SEVERITY_HIGH, low: list[str] = SEVERITY_LOW) -> Column:
    """Severity alone, see ``risk_judgement``."""
    every = sorted({*high, *low})
    return let(word_places(text, every), lambda p: _severity(p, high, low, every))


def page_unit(text: Column) -> Column:
    """Struct (multiplier, label) of the money unit named on a page."""
    out = F.struct(
        F.lit(DEFAULT_PAGE_UNIT[0]).alias("multiplier"), F.lit(DEFAULT_PAGE_UNIT[1]).alias("label")
    )
    for pattern, mult, label in reversed(PAGE_UNITS):
        out = F.when(
            text.rlike(pattern), F.struct(F.lit(mult).alias("multiplier"), F.lit(label).alias("label"))
        ).otherwise(out)
    return out


def header_unit(text: Column) -> Column:
    out = F.lit(DEFAULT_HEADER_UNIT)
    for pattern, mult in reversed(HEADER_UNITS):
        out = F.when(text.rlike(pattern), mult).otherwise(out)
    return out


def page_statement(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for label, pattern in reversed(STATEMENT_HEADINGS):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    # Every heading is bracketed, so most pages are decided by a plain search.
    return F.when(F.contains(text, F.lit("【")), out)


# A date, with the mark of a start or an end, in either width of digits. One pattern finds all, so a text is passed over once.
_D = "[0-9０-９]"
# The first look-ahead is the range that holds every character a date can begin with.
_ANY_DATE = rf"(?=[0-9令-９])(?:[自至]\s*)?(?:{_D}{{4}}|(?:令和|平成|昭和)\s*{_D}{{1,2}})\s*年\s*{_D}{{1,2}}\s*月\s*{_D}{{1,2}}\s*日"


def _dated(found: Column) -> Column:
    """Struct (mark, western, date) of a found date."""
    western = found.rlike(WESTERN_DATE)
    part = lambda pattern, i: F.regexp_extract(found, pattern, i)
    era_year = (era_offset(part(ERA_DATE, 1)) + part(ERA_DATE, 2).try_cast("int")).cast("string")
    date = F.when(western, iso_date(part(WESTERN_DATE, 1), part(WESTERN_DATE, 2), part(WESTERN_DATE, 3))).otherwise(
        iso_date(era_year, part(ERA_DATE, 3), part(ERA_DATE, 4))
    )
    return F.struct(F.substring(found, 1, 1).alias("mark"), western.alias("western"), date.alias("date"))


def page_periods(text: Column, header_chars: int | None = None) -> Column:
    """Array of (period_start, period_end, period_type, label) read from a page.

    Start and end dates are paired by order; without such pairs the distinct single dates are taken, western ones first.
    The first of several periods is the prior one. The whole page is read, once; ``header_chars`` limits it to a head of that length.
    """
    label = lambda i, n: F.when((i == 0) & (n > 1), "prior").otherwise("current")
    period = lambda start, end, kind, i, n: F.struct(
        start.alias("period_start"), end.alias("period_end"), F.lit(kind).alias("period_type"), label(i, n).alias("label")
    )
    dates_of = lambda found, wanted: F.transform(F.filter(found, wanted), lambda d: d["date"])

    def from_pairs(d: Column) -> Column:
        zipped = F.arrays_zip(d["starts"].alias("s"), d["ends"].alias("e"))
        return F.transform(zipped, lambda z, i: period(z["s"], z["e"], "duration", i, F.size(zipped)))

    def from_singles(found: Column) -> Column:
        dates = F.concat(dates_of(found, lambda d: d["western"]), dates_of(found, lambda d: ~d["western"]))
        none = F.lit(None).cast("string")
        return let(
            F.array_distinct(dates),
            lambda ds: F.transform(ds, lambda d, i: period(none, d, "instant", i, F.size(ds))),
        )

    def of_dates(found: Column) -> Column:
        marked = F.struct(dates_of(found, lambda d: d["mark"] == "自").alias("starts"), dates_of(found, lambda d: d["mark"] == "至").alias("ends"))
        return let(
            marked,
            lambda d: F.when((F.size(d["starts"]) > 0) & (F.size(d["starts"]) == F.size(d["ends"])), from_pairs(d))
            .otherwise(from_singles(found)),
        )

    head = text if header_chars is None else F.substring(text, 1, header_chars)
    found = F.regexp_extract_all(head, F.lit(_ANY_DATE), F.lit(0))
    return let(F.transform(found, lambda f: _dated(half_width(f))), of_dates)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1)


def ensure_https(url: Column) -> Column:
    return F.regexp_replace(url, "^http://", "https://")


def link_type(href: Column) -> Column:
    lower = F.lower(href)
    return (
        F.when(lower.endswith(".pdf"), "pdf")
        .when(lower.rlike(r"(\.html|\.htm|/)$") | F.contains(lower, F.lit("?")), "html")
        .otherwise("other")
    )


def url_join(base: Column, href: Column) -> Column:
    """Absolute form of the four usual links: absolute, scheme-relative, root-relative, relative."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(no_query == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(no_query, r"[^/]*$", "")
    )
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, href))
    )


def unescape(c: Column) -> Column:
    """The common HTML entities; the ampersand last, so that no text is decoded twice."""
    out = c
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def inner_text(fragment: Column) -> Column:
    """Text of an HTML fragment: every piece between tags trimmed, then joined."""
    pieces = F.transform(F.split(fragment, "<[^>]*>"), lambda p: strip(unescape(p)))
    return F.concat_ws("", pieces)


def element_html(html: Column, tag: str) -> Column:
    """Inner HTML of the first element of that tag; null when the page has none."""
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))


def meta_content(html: Column, attribute: str, value: str) -> Column:
    forward = rf'(?is)<meta\s[^>]*{attribute}\s*=\s*"{value}"[^>]*content\s*=\s*"([^"]*)"'
    backward = rf'(?is)<meta\s[^>]*content\s*=\s*"([^"]*)"[^>]*{attribute}\s*=\s*"{value}"'
    return F.when(html.rlike(forward), strip(unescape(F.regexp_extract(html, forward, 1)))).when(
        html.rlike(backward), strip(unescape(F.regexp_extract(html, backward, 1)))
    )

"""Web pages: page facts, links, and tables and lists read through one page reader."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.numbers import parse_jp_number, parse_market_cap, parse_plain_number
from ledgerloom.functions.text import element_html, inner_text, link_type, meta_content, url_join
from ledgerloom.rules.lexicons import IR_PATH

_ANCHOR = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'


def page_info(pages: DataFrame) -> DataFrame:
    """Title, description and company name: site name, else first heading, else title."""
    html = F.col("html")
    title = F.when(element_html(html, "title").isNotNull(), inner_text(element_html(html, "title")))
    heading = F.when(element_html(html, "h1").isNotNull(), inner_text(element_html(html, "h1")))
    return pages.select(
        "page_id", title.alias("title"), meta_content(html, "name", "description").alias("description"),
        F.coalesce(meta_content(html, "property", "og:site_name"), heading, title).alias("company_name"),
    )


def ir_links(pages: DataFrame, path: str = IR_PATH) -> DataFrame:
    """Distinct links of a page whose path matches, with the first one marked as the IR page."""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(1)).alias("href"),
        F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(2)).alias("body"),
    )
    links = pages.select("page_id", "url", F.posexplode(found).alias("pos", "a")).filter(F.col("a.href").rlike(path))
    href = F.col("a.href")
    rows = links.select("page_id", "pos", href.alias("href"), F.col("a.body").alias("body"), url_join(F.col("url"), href).alias("link_url"))
    first = rows.groupBy("page_id", "link_url").agg(F.min(F.struct("pos", "href", "body")).alias("f"))
    text = inner_text(F.col("f.body"))
    # The window holds the distinct links of one page.
    order = Window.partitionBy("page_id").orderBy("f.pos")
    return first.select(
        "page_id", "link_url", F.coalesce(F.nullif(text, F.lit("")), F.col("f.href")).alias("title"),
        link_type(F.col("f.href")).alias("link_type"), (F.row_number().over(order) == 1).alias("is_ir_page"),
    )


# ------------------------------------------------------------------ page reader

VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK_TAGS = {"a", "time", "p", "div", "span", "h1", "h3", "li", "section"}
# Blocks whose elements are read, and the marks of news sections.
BLOCKS = ("#stockinfo_i1", "#kessan_flash")
NEWS_MARK = r"(?i)^[#.].*(news|press|release)"
# What a page says that has no security to show.
NO_SUCH_TITLE = "該当なし"
NO_SUCH_NOTICE = ("該当する銘柄", "ありません")

_PART = [("tag", pa.string()), ("own", pa.list_(pa.string())), ("marks", pa.list_(pa.string())), ("href", pa.string()), ("text", pa.string())]
_CELL = [("heading", pa.bool_()), ("header", pa.string()), ("marks", pa.list_(pa.string())), ("text", pa.string())]
# What can be asked of a page, in the order of the document.
PAGE_PARTS = {
    "titles": ("array<string>", pa.list_(pa.string())),
    "notices": ("array<string>", pa.list_(pa.string())),
    "rows": (
        "array<struct<table_no:int,row_no:int,cells:array<struct<heading:boolean,header:string,marks:array<string>,text:string>>>>",
        pa.list_(pa.struct([("table_no", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.struct(_CELL)))])),
    ),
    "items": (
        "array<struct<item_no:int,parts:array<struct<tag:string,own:array<string>,marks:array<string>,href:string,text:string>>>>",
        pa.list_(pa.struct([("item_no", pa.int32()), ("parts", pa.list_(pa.struct(_PART)))])),
    ),
    "blocks": ("array<struct<tag:string,own:array<string>,marks:array<string>,href:string,text:string>>", pa.list_(pa.struct(_PART))),
}
BATCH_CHARS = 4_000_000

# Whole scripts, comments and declarations are one token each; a tag with an open quote ends at the next bracket.
_TOKEN = re.compile(
    r"""<(?:(?:script|style)\b[^>]*+>(?s:.*?)</(?:script|style)\s*+>|!--(?s:.*?)-->|[!?][^>]*+>"""
    r"""|(/?)([a-z][^\s/>]*+)([^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+|[^>]*+)>)""", re.I
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_NEWS = re.compile(NEWS_MARK)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found[name.lower()] = unescape("".join(values))
    return found


class _Element(NamedTuple):
    """An element with the marks (#id, .class, [section]) of itself and of those around it, the numbers of the table, row and list item it is in, and its
    place among the cells of its row. Its text is the pieces from ``begin`` to ``ends[number]``."""

    tag: str
    own: list[str]
    marks: list[str]
    table: int | None
    row: int | None
    item: int | None
    place: int | None
    href: str | None
    begin: int
    number: int


class _Page:
    """The recorded elements of a page, from one pass over its tokens.

    An element is open until its end tag, an end tag of an element around it, or the end of the page; an end tag without an open element is
    passed over. The text of an element is that of the pieces between its tags, each trimmed; the text of scripts is nobody's.
    """

    def __init__(self, html: str, recorded: frozenset[str], blocks: tuple[str, ...] = BLOCKS) -> None:
        self.pieces: list[str] = []
        self.found: list[_Element] = []
        self.ends: list[int | None] = []
        self.blocks = set(blocks)
        pieces, found, ends = self.pieces, self.found, self.ends
        tables = rows = items = 0
        cells: dict[int | None, int] = {}
        # What is open: tag, marks, table, row, item, and the number of the element if it is recorded.
        marks: list[str] = []
        stack: list[tuple] = [("", marks, None, None, None, None)]
        # Text and tags take turns: text, end mark, tag, attributes, text, ...
        tokens = _TOKEN.split(html)
        for at in range(0, len(tokens), 4):
            if (text := tokens[at]) and (piece := text.strip()):
                if "&" not in piece or (piece := unescape(piece).strip()):
                    pieces.append(piece)
            if at + 1 == len(tokens) or (tag := tokens[at + 2]) is None:
                continue
            tag = tag.lower()
            if tokens[at + 1]:
                self._close(stack, tag)
                continue
            if tag == "script" or tag == "style":
                break  # never closed, so the rest of the page is script
            _, marks, table, row, item, _ = stack[-1]
            own, href, attributes = [], None, tokens[at + 3]
            if "=" in attributes:
                given = _attributes(attributes)
                own = [f"#{given['id']}"] if given.get("id") else []
                own += [f".{c}" for c in given.get("class", "").split()]
                own += [f"[{given['data-section']}]"] if given.get("data-section") else []
                href = given.get("href")
                marks = marks + own if own else marks
            place = number = None
            if tag == "tr":
                row = rows = rows + 1
            elif tag == "td" or tag == "th":
                place = cells[row] = cells.get(row, 0) + 1
            elif tag == "li":
                item = items = items + 1
            elif tag == "table":
                table = tables = tables + 1
            if tag in recorded:
                number = len(found)
                found.append(_Element(tag, own, marks, table, row, item, place, href, len(pieces), number))
                ends.append(None)
            if tag not in VOID_TAGS:
                stack.append((tag, marks, table, row, item, number))
                if attributes.endswith("/"):
                    self._close(stack, tag)

    def _close(self, stack: list[tuple], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                for *_, number in stack[i:]:
                    if number is not None:
                        self.ends[number] = len(self.pieces)
                del stack[i:]
                return

    def text(self, e: _Element) -> str:
        return "".join(self.pieces[e.begin : self.ends[e.number]])

    def part(self, name: str) -> list:
        return getattr(self, f"_{name}")()

    def _titles(self) -> list[str]:
        return [self.text(e) for e in self.found if e.tag == "title"]

    def _notices(self) -> list[str]:
        texts = (self.text(e) for e in self.found if e.tag in ("p", "div"))
        return [t for t in texts if all(w in t for w in NO_SUCH_NOTICE)]

    def _rows(self) -> list[dict]:
        """Rows with their cells. The first row of a table with a heading cell names the columns; the cells of later rows carry the name
        of their column."""
        rows: dict[int, list[_Element]] = {}
        for e in self.found:
            if e.place is not None and e.row is not None:
                rows.setdefault(e.row, []).append(e)
        heads: dict[int, list[str]] = {}
        out = []
        for number in sorted(rows):
            cells = rows[number]
            table = cells[0].table
            names = heads.get(table, [])
            out.append({
                "table_no": table, "row_no": number,
                "cells": [
                    {"heading": c.tag == "th", "header": names[c.place - 1] if c.place <= len(names) else None, "marks": c.marks, "text": self.text(c)}
                    for c in cells
                ],
            })
            if table is not None and table not in heads and (titles := [self.text(c) for c in cells if c.tag == "th"]):
                heads[table] = titles
        return out

    def _as_part(self, e: _Element) -> dict:
        return {"tag": e.tag, "own": e.own, "marks": e.marks, "href": e.href, "text": self.text(e)}

    def _items(self) -> list[dict]:
        items: dict[int, list[dict]] = {}
        for e in self.found:
            if e.item is not None and e.tag in BLOCK_TAGS and any(map(_NEWS.search, e.marks)):
                items.setdefault(e.item, []).append(self._as_part(e))
        return [{"item_no": number, "parts": parts} for number, parts in items.items()]

    def _blocks(self) -> list[dict]:
        return [self._as_part(e) for e in self.found if e.tag in BLOCK_TAGS and not self.blocks.isdisjoint(e.marks)]


# The elements that each part needs.
_RECORDED = {"titles": {"title"}, "notices": {"p", "div"}, "rows": {"th", "td"}, "items": BLOCK_TAGS, "blocks": BLOCK_TAGS}


def page_parts(pages: DataFrame, *wanted: str, blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """One row per page with the wanted parts as nested arrays (names and order: ``PAGE_PARTS``, default: all).

    A page is read once, in one pass, and only what is asked for leaves the reader; everything after it is array functions on the
    row, so no page is shuffled. The batches that are handed on are bounded by characters.
    """
    names = [n for n in PAGE_PARTS if not wanted or n in wanted]
    id_type = pages.schema["page_id"].dataType.simpleString()
    recorded = frozenset().union(*(_RECORDED[n] for n in names))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size, out = 0, 0, {n: [] for n in names}
            for i, html in enumerate(batch.column(1)):
                page = _Page(html.as_py() or "", recorded, blocks)
                for n in names:
                    out[n].append(page.part(n))
                size += sum(map(len, page.pieces))
                if size >= BATCH_CHARS or i + 1 == batch.num_rows:
                    arrays = [pa.array(out[n], PAGE_PARTS[n][1]) for n in names]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), *arrays], names=["page_id", *names])
                    begin, size, out = i + 1, 0, {n: [] for n in names}

    return pages.select("page_id", "html").mapInArrow(read, ", ".join([f"page_id {id_type}", *(f"{n} {PAGE_PARTS[n][0]}" for n in names)]))


def _under(marks: Column, *wanted: str) -> Column:
    return F.arrays_overlap(marks, F.array(*[F.lit(m) for m in wanted]))


def _texts(parts: Column, condition: Callable[[Column], Column]) -> Column:
    return F.transform(F.filter(parts, condition), lambda p: p["text"])


def _first_text(parts: Column, condition: Callable[[Column], Column]) -> Column:
    return F.get(_texts(parts, condition), F.lit(0))


def _classed(pattern: str) -> Callable[[Column], Column]:
    return lambda p: F.exists(p["own"], lambda m: m.rlike(rf"^\..*({pattern})"))


def html_tables(parts: DataFrame) -> DataFrame:
    """Cells of header tables: one row per page, table, row and header."""
    rows = parts.select("page_id", F.explode("rows").alias("r")).select("page_id", "r.table_no", "r.row_no", F.explode("r.cells").alias("c"))
    return rows.filter(F.col("c.header").isNotNull()).select("page_id", "c.marks", "table_no", "row_no", "c.header", F.col("c.text").alias("cell"))


# Column names of the result, price and indicator tables, in order of preference.
RESULT_HEADERS = {
    "period": ("決算期", "期"), "revenue": ("売上高", "売上"), "operating_income": ("営業益", "営業利益"),
    "ordinary_income": ("経常益", "経常利益"), "net_income": ("最終益", "純利益"), "eps": ("1株益", "EPS"),
}
PRICE_HEADERS = {"prev_close": "前日終値", "open": "始値", "high": "高値", "low": "安値", "volume": "出来高"}


def table_results(parts: DataFrame) -> DataFrame:
    """Result rows of a page's financial table."""
    titled = F.filter("r.cells", lambda c: c["header"].isNotNull() & _under(c["marks"], "#financial_td"))
    rows = parts.select("page_id", F.explode("rows").alias("r")).select("page_id", "r.row_no", titled.alias("cells")).filter(F.size("cells") > 0)
    of = lambda name: F.array_max(_texts(F.col("cells"), lambda c: c["header"] == name))
    wide = rows.select("page_id", "row_no", *[F.coalesce(*[of(h) for h in names]).alias(k) for k, names in RESULT_HEADERS.items()])
    return wide.select(
        "page_id", "row_no", "period", *[parse_plain_number(F.col(k)).alias(k) for k in RESULT_HEADERS if k != "period"]
    )


def table_prices(parts: DataFrame) -> DataFrame:
    """Current price, change, the day's prices and the indicators of a page."""
    in_block = lambda own: _first_text(F.col("blocks"), lambda p: _under(p["marks"], "#stockinfo_i1") & F.array_contains(p["own"], F.lit(own)))
    # The last row with a header counts, as later rows overwrite earlier ones; of cells of one row, the greatest text.
    titled = lambda r: F.filter(r["cells"], lambda c: c["header"].isNotNull() & _under(c["marks"], "#stockinfo_i2", "#stockinfo_i3"))
    placed = lambda r: F.transform(titled(r), lambda c: F.struct(c["header"].alias("header"), r["table_no"], r["row_no"], c["text"]))
    cells = parts.select("page_id", "blocks", F.flatten(F.transform("rows", placed)).alias("cells"))
    of = lambda name: F.array_max(F.filter("cells", lambda c: c["header"] == name))["text"]
    texts = {"current": in_block(".kabuka"), "change": in_block(".change"), **{k: of(h) for k, h in PRICE_HEADERS.items()},
             "per": of("PER"), "pbr": of("PBR"), "dividend_yield": of("利回り"), "market_cap": of("時価総額")}
    found = cells.select("page_id", *[c.alias(k) for k, c in texts.items()])
    return found.select(
        "page_id", *[(parse_market_cap if k == "market_cap" else parse_plain_number)(F.col(k)).alias(k) for k in texts]
    )


def page_news(parts: DataFrame) -> DataFrame:
    """Items of a page's news section with link, title and date."""
    items = parts.select("page_id", F.explode("items").alias("i")).select("page_id", "i.item_no", "i.parts")
    link = F.get(F.filter("parts", lambda p: p["tag"] == "a"), F.lit(0))
    time = _first_text(F.col("parts"), lambda p: p["tag"] == "time")
    dated = _first_text(F.col("parts"), lambda p: F.exists(p["own"], lambda m: m.rlike(r"(?i)^\..*(date|time)")))
    rows = items.select("page_id", "item_no", link.alias("link"), F.coalesce(time, dated).alias("date")).filter(F.col("link").isNotNull())
    return rows.select("page_id", "item_no", F.col("link.text").alias("title"), F.col("link.href").alias("href"), "date")


def definition_tables(parts: DataFrame, sections: tuple[str, ...] = ("earnings-forecast", "consensus")) -> DataFrame:
    """Heading and value of each row in the named sections."""
    rows = parts.select("page_id", F.explode("rows").alias("r")).select("page_id", "r.row_no", "r.cells")
    # A cell counts for the outermost of the sections around it.
    section = lambda c: F.get(F.filter(c["marks"], lambda m: m.isin(*[f"[{s}]" for s in sections])), F.lit(0))
    within = lambda s: F.struct(F.lit(s).alias("section"), F.filter("cells", lambda c: section(c) == f"[{s}]").alias("cells"))
    each = rows.select("page_id", "row_no", F.explode(F.array(*map(within, sections))).alias("s")).select("page_id", "row_no", "s.*")
    name, value = _first_text(F.col("cells"), lambda c: c["heading"]), _first_text(F.col("cells"), lambda c: ~c["heading"])
    return each.select("page_id", "section", "row_no", name.alias("name"), value.alias("value")).filter("name IS NOT NULL AND value IS NOT NULL")


def shareholder_rows(parts: DataFrame) -> DataFrame:
    """First two cells of each shareholder row."""
    held = F.filter("r.cells", lambda c: ~c["heading"] & _under(c["marks"], "[shareholders]"))
    rows = parts.select("page_id", F.explode("rows").alias("r")).select("page_id", "r.row_no", held.alias("c"))
    return rows.filter(F.size("c") >= 2).select("page_id", "row_no", F.col("c")[0]["text"].alias("name"), F.col("c")[1]["text"].alias("ratio"))


def earnings_flash(parts: DataFrame) -> DataFrame:
    """Title, date and content of the flash block of a page."""
    inside = F.filter("blocks", lambda p: _under(p["marks"], "#kessan_flash") & ~F.array_contains(p["own"], F.lit("#kessan_flash")))
    rows = parts.select("page_id", inside.alias("p"))
    first = lambda condition: _first_text(F.col("p"), condition)
    tagged = lambda *tags: lambda p: p["tag"].isin(*tags)
    headed = first(lambda p: p["tag"].isin("h3", "a", "span") & _classed("title|heading")(p))
    found = rows.select(
        "page_id", F.coalesce(F.nullif(headed, F.lit("")), first(tagged("a"))).alias("title"),
        F.coalesce(first(tagged("time")), first(_classed("date"))).alias("date"),
        F.coalesce(first(tagged("p")), first(_classed("content|body"))).alias("content"),
    )
    usable = lambda c: F.coalesce(c != "", F.lit(False))
    return found.filter(usable(F.col("title")) | usable(F.col("content")))


def not_found_pages(parts: DataFrame) -> DataFrame:
    """Whether a page says that the security does not exist."""
    said = F.exists("titles", lambda t: F.contains(t, F.lit(NO_SUCH_TITLE)))
    return parts.select("page_id", (said | (F.size("notices") > 0)).alias("not_found"))


# ------------------------------------------------------------------ state embedded in a script

_STATE = r"(?s)window\.__PRELOADED_STATE__\s*=\s*(\{.+?\})\s*;?\s*</script>"


def embedded_state(pages: DataFrame) -> DataFrame:
    """JSON state assigned in a page's script, as VARIANT; null when absent or malformed."""
    return pages.select("page_id", F.try_parse_json(F.regexp_extract("html", _STATE, 1)).alias("state"))


def state_figures(states: DataFrame) -> DataFrame:
    """Price and indicators of the embedded state."""
    num = lambda path: parse_jp_number(F.try_variant_get("state", path, "string"))
    board, detail, ref = "$.mainStocksPriceBoard", "$.mainStocksDetail.detail", "$.mainStocksDetail.referenceIndex"
    return states.filter(F.col("state").isNotNull()).select(
        "page_id",
        F.coalesce(num(f"{board}.price"), num(f"{board}.savePrice")).alias("current"),
        num(f"{board}.priceChange").alias("change"), num(f"{board}.priceChangeRate").alias("change_percent"),
        num(f"{detail}.volume").cast("bigint").alias("volume"), num(f"{detail}.tradingValue").alias("turnover"),
        num(f"{ref}.per").alias("per"), num(f"{ref}.pbr").alias("pbr"),
        F.coalesce(num(f"{ref}.shareDividendYield"), num(f"{board}.shareDividendYield")).alias("dividend_yield"),
        (num(f"{ref}.totalPrice") * 1e6).alias("market_cap"),
        num(f"{ref}.sharesIssued").cast("bigint").alias("shares_outstanding"),
    )


def state_performance(states: DataFrame) -> DataFrame:
    """Yearly revenue, and operating income estimated from the margin."""
    items = F.from_json(
        F.to_json(F.try_variant_get("state", "$.stockPerformance.chartInfo", "variant")),
        "array<struct<date:string,amount:double,profitMargin:double>>",
    )
    date = F.col("i.date")
    return states.select("page_id", F.posexplode(items).alias("place", "i")).select(
        "page_id", "place",
        F.when(F.length(date) == 6, F.concat(F.substring(date, 1, 4), F.lit("-"), F.substring(date, 5, 2))).otherwise(F.coalesce(date, F.lit(""))).alias("period"),
        F.col("i.amount").alias("revenue"), F.rint(F.col("i.amount") * F.col("i.profitMargin") / 100.0).alias("operating_income"),
    )


def state_news(states: DataFrame) -> DataFrame:
    """Articles of the state; its topics only when there is no article."""
    article = "struct<title:string,url:string,date:string>"
    read = lambda path, kind: F.from_json(F.to_json(F.try_variant_get("state", path, "variant")), kind)
    articles = F.coalesce(read("$.mainStocksNews.articles", f"array<{article}>"), F.array().cast(f"array<{article}>"))
    topics = read("$.symbolTopics.topics", f"array<struct<date:string,sources:array<{article}>>>")
    from_topics = F.flatten(
        F.transform(
            topics,
            lambda tp: F.transform(
                F.filter(tp["sources"], lambda s: (F.coalesce(s["title"], F.lit("")) != "") & (F.coalesce(s["url"], F.lit("")) != "")),
                lambda s: F.struct(s["title"].alias("title"), s["url"].alias("url"), F.coalesce(s["date"], tp["date"], F.lit("")).alias("date")),
            ),
        )
    )
    chosen = F.when(F.size(articles) > 0, articles).otherwise(F.coalesce(from_topics, F.array().cast(f"array<{article}>")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return states.select("page_id", F.posexplode(chosen).alias("place", "a")).select(
        "page_id", "place", blank(F.col("a.title")).alias("title"), blank(F.col("a.url")).alias("url"), blank(F.col("a.date")).alias("date")
    )

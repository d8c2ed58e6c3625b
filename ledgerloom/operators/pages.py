"""Statement pages as text: headings, spans, item lines, periods and candidate extractions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.numbers import CELL_NULLS, parse_statement_cell, strip
from ledgerloom.functions.text import page_periods, page_statement, page_unit
from ledgerloom.operators.ranking import landed
from ledgerloom.rules.concepts import item_concept

_CELL_START = r"[※０-９\d△▲（(－\-]"
TWO_VALUES = rf"^(.+?)\s+({_CELL_START}[^\n]*?)\s+({_CELL_START}[^\n]*?)$"
ONE_VALUE = rf"^(.+?)\s+({_CELL_START}[,\d０-９，．.※]+)$"


# Fixed value: rows at the head of a page in which a unit marks a continued table.
HEAD_ROWS = 3


def statement_headers(pages: DataFrame) -> DataFrame:
    """Pages with the statement their heading names, null on other pages."""
    return pages.withColumn("statement", page_statement(F.col("text")))


def first_pages(headers: DataFrame) -> DataFrame:
    """First page of each statement per document."""
    return headers.filter(F.col("statement").isNotNull()).groupBy("document_id", "statement").agg(
        F.min("page_no").alias("page_no")
    )


def is_continuation(text: Column) -> Column:
    """A page continues a statement when it names a money unit in its head rows, the first ``HEAD_ROWS``."""
    head = F.substring_index(text, "\n", HEAD_ROWS)
    return reduce(lambda a, b: a | b, [F.contains(head, F.lit(w)) for w in ("単位", "千円", "百万円")])


def statement_spans(headers: DataFrame, max_pages: int | None = None, block_pages: int = 1000) -> DataFrame:
    """Pages of each statement: from its first heading up to the next heading or the first other page.

    With ``max_pages`` the last statement of a document takes at most so many pages. The texts are read once: the page flags are
    written, and everything after works on them. A document is worked on in blocks of pages: inside a block
    the latest opening is a running value, and what a block takes over from earlier ones comes from one
    row per block. So a very long document is spread over many tasks.
    """
    flags = landed(headers.select("document_id", "page_no", "statement", is_continuation(F.col("text")).alias("continues")))
    first = first_pages(flags)
    marked = flags.join(first.withColumn("is_first", F.lit(True)), ["document_id", "statement", "page_no"], "left")
    marked = marked.withColumn("block", F.floor(F.col("page_no") / block_pages))
    opening = F.struct("page_no", "statement", F.coalesce("is_first", F.lit(False)).alias("is_first"))
    stops = F.col("statement").isNotNull() | ~F.col("continues")
    opens = marked.withColumn("opening", F.when(stops, opening))
    inside = Window.partitionBy("document_id", "block").orderBy("page_no")
    earlier = Window.partitionBy("document_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        opens.groupBy("document_id", "block").agg(F.max("opening").alias("last_opening"))
        .select("document_id", "block", F.last("last_opening", ignorenulls=True).over(earlier).alias("carried"))
    )
    running = opens.withColumn("own", F.last("opening", ignorenulls=True).over(inside)).join(carried, ["document_id", "block"])
    o = F.coalesce("own", "carried")
    spans = running.filter(o["is_first"] & o["statement"].isNotNull())
    if max_pages is not None:
        last_first = first.groupBy("document_id").agg(F.max("page_no").alias("last_first"))
        within = (F.col("page_no") - o["page_no"] < max_pages) | (o["page_no"] < F.col("last_first"))
        spans = spans.join(last_first, "document_id").filter(within)
    return spans.select(
        "document_id", "page_no", o["statement"].alias("statement"), o["page_no"].alias("first_page")
    )


def text_lines(pages: DataFrame, columns: int = 3) -> DataFrame:
    """Item lines of known concepts with one or two value texts."""
    lines = pages.select("document_id", "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    pattern = TWO_VALUES if columns >= 3 else ONE_VALUE
    part = lambda i: strip(F.regexp_extract("line", pattern, i))
    matched = lines.filter(F.col("line").rlike(pattern)).select(
        "document_id", "page_no", "line_no", part(1).alias("item"), part(2).alias("value_1"),
        (part(3) if columns >= 3 else F.lit(None).cast("string")).alias("value_2"),
    )
    return matched.withColumn("concept", item_concept(F.col("item"))).filter(F.col("concept").isNotNull())


def page_period_rows(pages: DataFrame) -> DataFrame:
    """Periods named at the head of each page, in order."""
    return pages.select(
        "document_id", "page_no", F.posexplode(page_periods(F.col("text"))).alias("place", "p")
    ).select("document_id", "page_no", "place", "p.*")


def page_figures(pages: DataFrame) -> DataFrame:
    """Amounts of the item lines in the page's unit."""
    unit = page_unit(F.col("text"))["multiplier"]
    lines = text_lines(pages)
    units = pages.select("document_id", "page_no", unit.alias("unit"))
    return lines.join(units, ["document_id", "page_no"]).select(
        "document_id", "page_no", "line_no", "concept",
        parse_statement_cell(F.col("value_1"), F.col("unit")).alias("amount_1"),
        parse_statement_cell(F.col("value_2"), F.col("unit")).alias("amount_2"),
    )


def filled(cell: Column) -> Column:
    return F.coalesce(~strip(cell).isin(*CELL_NULLS), F.lit(False))


def concept_scores(rows: DataFrame) -> DataFrame:
    """Distinct known concepts, periods and filled value columns per candidate extraction."""
    concept = item_concept(F.col("c0"))
    return rows.groupBy("document_id", "strategy_id").agg(
        F.countDistinct(concept).alias("score"),
        F.countDistinct("period_header").alias("periods"),
        F.max("width").alias("width"),
        (F.max(filled(F.col("c1"))).cast("int") + F.max(filled(F.col("c2"))).cast("int")).alias("value_columns"),
    )


def best_candidate(scores: DataFrame) -> DataFrame:
    """Chosen extraction per document: most periods, then most concepts, then the first strategy.

    When the winner has fewer filled value columns than its rows are wide, the next candidate with all
    of them and no lower score takes over. A document has a handful of candidates.
    """
    order = [F.desc("periods"), F.desc("score"), F.asc("strategy_id")]
    w = Window.partitionBy("document_id").orderBy(*order)
    ranked = scores.withColumn("place", F.row_number().over(w))
    winner = Window.partitionBy("document_id")
    first = lambda c: F.max(F.when(F.col("place") == 1, F.col(c))).over(winner)
    expected = F.greatest(first("width") - 1, F.lit(0))
    lost = first("value_columns") < expected
    replaces = (F.col("place") > 1) & lost & (F.col("value_columns") >= expected) & (F.col("score") >= first("score"))
    judged = ranked.select("*", replaces.alias("replaces"))
    pick = F.coalesce(
        F.min(F.when(F.col("replaces"), F.struct("place", "strategy_id", "score"))),
        F.min(F.struct("place", "strategy_id", "score")),
    )
    return judged.groupBy("document_id").agg(pick.alias("p")).select(
        "document_id", "p.strategy_id", "p.score", (F.col("p.place") > 1).alias("replaced")
    )


def modal_width_rows(rows: DataFrame) -> DataFrame:
    """Rows of the most common width per candidate; repeated header rows and unnamed rows drop out.

    Of equally common widths the one met first counts.
    """
    keys = ["document_id", "strategy_id"]
    widths = rows.groupBy(*keys, "width").agg(F.count("*").alias("n"), F.min("row_no").alias("first_row"))
    modal = widths.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("first_row")).alias("f"), "width"))["width"].alias("width"))
    kept = rows.join(modal, [*keys, "width"])
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ("c0", "c1", "c2")])
    is_date = lambda c: F.coalesce(F.contains(c, F.lit("年度")) | (F.contains(c, F.lit("年")) & F.contains(c, F.lit("月"))), F.lit(False))
    header = text.rlike("単位|千円|百万円") | reduce(lambda a, b: a | b, [is_date(F.col(c)) for c in ("c0", "c1", "c2")])
    tagged = kept.select("*", header.alias("is_header"), text.alias("row_text"))
    data = tagged.filter(~F.col("is_header") & (strip(F.col("c0")) != ""))
    first_headers = (
        tagged.filter("is_header").groupBy(*keys, "width", "row_text")
        .agg(F.min("row_no").alias("row_no"))
    )
    out = [*keys, "width", "row_no", "row_text"]
    return data.select(*out, F.lit(False).alias("is_header")).unionByName(first_headers.select(*out, F.lit(True).alias("is_header")))

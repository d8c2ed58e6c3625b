"""The page reader against a plain parser, on tag soup: unclosed, nested and stray tags, comments, scripts, entities."""

import random
from html.parser import HTMLParser

import pytest

from ledgerloom.operators import html as O


RECORDED = frozenset({"title", "table", "tr", "th", "td", "li", "ul", "b", *O.BLOCK_TAGS})


class Plain(HTMLParser):
    """Every element with its marks and text, and cells by row, with a list per open element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [{"tag": "", "marks": [], "table": None, "row": None, "item": None, "text": []}]
        self.seen, self.counts, self.cells = [], {"table": 0, "tr": 0, "li": 0}, {}

    def handle_starttag(self, tag, attrs):
        given, up = dict(attrs), self.stack[-1]
        own = ([f"#{given['id']}"] if given.get("id") else []) + [f".{c}" for c in (given.get("class") or "").split()]
        own += [f"[{given['data-section']}]"] if given.get("data-section") else []
        e = {"tag": tag, "own": own, "marks": up["marks"] + own, "href": given.get("href"), "text": [], "place": None}
        e |= {k: up[k] for k in ("table", "row", "item")}
        if tag in self.counts:
            self.counts[tag] += 1
            e[{"table": "table", "tr": "row", "li": "item"}[tag]] = self.counts[tag]
        if tag in ("td", "th"):
            e["place"] = self.cells[e["row"]] = self.cells.get(e["row"], 0) + 1
        self.seen.append(e)
        if tag not in O.VOID_TAGS:
            self.stack.append(e)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i]["tag"] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if data.strip() and self.stack[-1]["tag"] not in ("script", "style"):
            for e in self.stack:
                e["text"].append(data.strip())


def plainly(html):
    reader = Plain()
    reader.feed(html)
    reader.close()
    return [(e["tag"], e["own"], e["marks"], e["table"], e["row"], e["item"], e["place"], e["href"], "".join(e["text"])) for e in reader.seen if e["tag"] in RECORDED]


def by_reader(html):
    page = O._Page(html, RECORDED)
    return [(*e[:8], page.text(e)) for e in page.found]


TAGS = ["table", "tr", "td", "th", "td", "tr", "ul", "li", "div", "p", "a", "span", "b", "section", "time"]
PIECES = [
    " x ", "売上 高", "&amp; Co", "&nbsp;", "1 &lt; 2", "<!-- <td>no</td> -->", "<br>", "<br/>", "<img src='a>b'>", "<script>var t = '<td>';</script>",
    "<style>p > a {}</style>", "</td>", "</table>", "</p>", "</nothing>", "\n", "<DIV CLASS='One  two' id=box>", "</DIV>", "<!DOCTYPE html>",
]


@pytest.mark.parametrize("seed", range(60))
def test_reader_equals_a_plain_parser(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(rng.randrange(5, 90)):
        tag = rng.choice(TAGS)
        attributes = rng.choice(["", "", ' id="financial_td"', ' class="news list"', " data-section='consensus'", ' href="/a?b=1&amp;c=2"', " hidden"])
        out.append(rng.choice([f"<{tag}{attributes}>", f"<{tag}{attributes}>", f"</{tag}>", f"</{tag} >", rng.choice(PIECES)]))
    html = "".join(out)
    assert by_reader(html) == plainly(html)


def test_unclosed_and_nested_tables(spark):
    html = """<div id=financial_td><table><tr><td>note<tr><th>決算期</th><th>売上高</tr><tr><td>2024.03</td><td>1,000<table><tr><th>in</th></tr><tr><td>side</td></tr></table></td></tr>
    <tr><td>2023.03</td><td>7</td><td>beyond</td></tr></div><p>after"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<table><tr><td>no heading</td></tr></table>"), (5, "<script>x")], "page_id long, html string")
    parts = O.page_parts(pages)
    assert parts.count() == 5
    cells = {(r.page_id, r.table_no, r.header, r.cell) for r in O.html_tables(parts).collect()}
    assert cells == {(1, 1, "決算期", "2024.03"), (1, 1, "売上高", "1,000inside"), (1, 2, "in", "side"), (1, 1, "決算期", "2023.03"), (1, 1, "売上高", "7")}
    # The row of the inner table has none of the wanted columns.
    assert {(r.period, r.revenue) for r in O.table_results(parts).collect()} == {("2023.03", 7.0), ("2024.03", None), (None, None)}


def test_nothing_is_shuffled_before_the_rows(spark):
    pages = spark.createDataFrame([(1, "<p>x")], "page_id long, html string")
    parts = O.page_parts(pages)
    for rows in (O.html_tables, O.table_results, O.table_prices, O.page_news, O.definition_tables, O.shareholder_rows, O.earnings_flash, O.not_found_pages):
        plan = rows(parts)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_batches_are_bounded(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "<title>" + "t" * 50 + "</title>") for i in range(30)], "page_id long, html string").coalesce(1)
    monkeypatch.setattr(O, "BATCH_CHARS", 120)
    assert sorted(r.page_id for r in O.page_parts(pages, "titles").collect()) == list(range(30))

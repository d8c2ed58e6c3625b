"""Benchmark decontamination over a distributed positional inverted index.

Words are lower-cased (A-Z only) runs of letters, digits and everything beyond ASCII. A benchmark text gives windows of
``width`` consecutive words; a text of fewer words, but not none, is one window. For every window the rarest of its terms
that stand in the training texts are its anchors. The index stores the postings (document, position) of anchor terms only, with
positions as they are; a window's lists are shifted by the anchors' offsets and intersected, which leaves the starts at which all
anchors stand in place. Those are compared word by word for exact phrases.

A proximity match is a run of words that has the words of a window in their order, all but one (none may be missing from windows
of fewer than five words), with at most three other words among them (three tenths of the window for shorter ones). So a word
may be inserted, dropped, replaced or moved. Of three anchors one can be the missing word, so two must stand close to their
places, or all where the missing word is one that no training text has. Those places are compared word by word too. Runs that overlap
an exact match of the same window are not reported again.

Missing and empty texts have no words and match nothing. Documents are told apart by id and text, so repeated rows all get their
matches. Items of equal phrases are all reported. Columns other than id and text are not read. An empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import INDEX_WORD, ascii_lower, let, stored, workspace

WIDTH = 10
ANCHORS = 3
SLACK = 3
CORE = 60


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(INDEX_WORD), 0)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``w`` (a number made from the words), ``ws`` and the ids of the items that have it, as text."""
    words = items.select(items[id_col].cast("string").alias("item"), words_of(items[text_col]).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ws") - width + 1))
    each = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("ws", i, F.lit(width)))).alias("ws"))
    found = each.groupBy("ws").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return found.select(F.xxhash64("ws").alias("w"), "ws", "items")


def term_counts(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How often each of ``terms`` stands in all texts. Counts are combined in the tasks before they are shuffled."""
    each = docs.select(F.explode(words_of(docs[text_col])).alias("term"))
    return each.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def _missing(size: Column) -> Column:
    """How many words of a window a proximity match may lack."""
    return F.least(F.lit(1), F.floor(size / 5)).cast("int")


def _slack(size: Column) -> Column:
    """How many other words may stand among those of a window."""
    return F.least(F.lit(SLACK), F.floor(size * 3 / 10)).cast("int")


def anchors(wins: DataFrame, counts: DataFrame, number: int = ANCHORS) -> DataFrame:
    """The rarest known terms of every window: (w, slot, slots, least, slack, term, offset), ``least`` being how many of the
    ``slots`` a match has in any case. Windows that lack more words than a proximity match may cannot occur and go."""
    each = wins.select("w", F.posexplode("ws").alias("offset", "term"), F.size("ws").alias("size"))
    known = each.join(counts, "term")
    inside = Window.partitionBy("w").orderBy("n", "term", "offset")
    ranked = known.select(
        "*", F.row_number().over(inside).alias("slot"), F.count("*").over(Window.partitionBy("w")).cast("int").alias("found")
    )
    spare = _missing(F.col("size")) - (F.col("size") - F.col("found"))
    slots = F.least("found", F.lit(number))
    return ranked.where((spare >= 0) & (F.col("slot") <= number)).select(
        "w", "slot", slots.alias("slots"), F.greatest(F.lit(1), slots - spare).alias("least"), _slack(F.col("size")).alias("slack"), "term", "offset"
    )


def postings(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: (term, id, h, pos) of every occurrence of the given terms."""
    keyed = _keyed(docs, id_col, text_col)
    each = keyed.select("id", "h", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return each.join(terms, "term").select("term", "id", "h", "pos")


def shifted(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """Postings moved to the start of the window that they would belong to: (id, h, w, slot, slots, least, slack, start)."""
    rows = index.join(chosen, "term")
    return rows.select("id", "h", "w", "slot", "slots", "least", "slack", (F.col("pos") - F.col("offset")).alias("start"))


def starts_of(lists: DataFrame, slack: int = SLACK) -> DataFrame:
    """(id, h, w, exact, near): starts at which every anchor stands in its place, and starts, these among them, from which
    enough anchors stand within the window's slack, though no more than ``slack``.

    Starts fall into bins of ``CORE``, each with the next ``slack`` starts, and every anchor's starts in a bin are the bits of one
    number; so the groups are combined in hash tables, and a term that fills a document gives no pairs. A term that
    a window has twice is two slots; repeated rows of a document say the same.
    """
    one = F.lit(1).cast("bigint")
    shift = lambda value, by: F.call_function("shiftleft", value, by)
    place = F.col("start") + slack
    rows = lists.where(F.col("start") >= -slack).withColumn("bin", F.floor(place / CORE).cast("int"))
    bit = place - F.col("bin") * CORE
    own = F.struct(F.col("bin").alias("bin"), bit.alias("bit"))
    before = F.struct((F.col("bin") - 1).alias("bin"), (bit + CORE).alias("bit"))
    both = F.when((bit < slack) & (F.col("bin") > 0), F.array(own, before)).otherwise(F.array(own))
    rows = rows.select("id", "h", "w", "slot", "slots", "least", "slack", F.explode(both).alias("c"))
    held = [F.bit_or(F.when(F.col("slot") == k, shift(one, F.col("c.bit"))).otherwise(F.lit(0).cast("bigint"))).alias(f"m{k}") for k in range(1, ANCHORS + 1)]
    rows = rows.groupBy("id", "h", "w", F.col("c.bin").alias("bin")).agg(*held, *(F.first(c).alias(c) for c in ("slots", "least", "slack")))

    def every(bits):
        return reduce(Column.bitwiseAND, bits)

    def some(bits):
        return reduce(Column.bitwiseOR, bits)

    def or_all(k, bits):  # a slot that the window does not have excludes nothing
        return F.when(F.col("slots") >= k, bits).otherwise(F.lit(-1).cast("bigint"))

    raw = [or_all(k, F.col(f"m{k}")) for k in range(1, ANCHORS + 1)]
    reach = lambda k: some([F.when(F.col("slack") >= d, F.shiftrightunsigned(f"m{k}", d)).otherwise(F.lit(0).cast("bigint")) for d in range(slack + 1)])
    wide = rows.select("*", every(raw).alias("exact"), *(or_all(k, reach(k)).alias(f"r{k}") for k in range(1, ANCHORS + 1)))
    reached = [F.col(f"r{k}") for k in range(1, ANCHORS + 1)]
    all_but_one = some([every([r for r in reached if r is not out]) for out in reached])
    begins = some([F.col(f"m{k}") for k in range(1, ANCHORS + 1)])
    near = F.when(F.col("least") >= F.col("slots"), every(reached)).otherwise(all_but_one).bitwiseAND(begins)
    core = F.lit((1 << CORE) - 1)
    found = wide.select("id", "h", "w", "bin", F.col("exact").bitwiseAND(core).alias("exact"), near.bitwiseAND(core).alias("near"))
    found = found.where("exact <> 0 OR near <> 0")

    def places(bits):
        set_in = lambda value: F.filter(F.sequence(F.lit(0), F.lit(CORE - 1)), lambda b: F.call_function("shiftrightunsigned", value, b).bitwiseAND(one) == 1)
        return F.transform(let(bits, set_in), lambda b: F.col("bin") * CORE + b - slack)

    return found.select("id", "h", "w", F.filter(places(F.col("exact")), lambda s: s >= 0).alias("exact"), places(F.col("near")).alias("near"))


def intersect(lists: DataFrame) -> DataFrame:
    """Starts at which every anchor of a window stands in its place."""
    return starts_of(lists).select("id", "h", "w", F.explode("exact").alias("start"))


def proximity(lists: DataFrame, slack: int = SLACK) -> DataFrame:
    """Windows with enough anchors within ``slack`` words of each other's places, and not all in them: (id, h, w, starts)."""
    near = F.array_except("near", "exact")
    return starts_of(lists, slack).select("id", "h", "w", near.alias("starts")).where(F.size("starts") > 0)


def candidates(docs: DataFrame, items: DataFrame, width: int, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """(id, h, asked): per document the windows to compare, with the exact and near starts that the index gives.

    They are bounded by the document's own words, and written before the texts are read for the comparison, so Spark knows
    their size when it decides how to join them.
    """
    with workspace(docs.sparkSession) as keep:
        wins = stored(windows(items, width, item_col, item_text_col), "windows")
        vocabulary = wins.select(F.explode("ws").alias("term")).distinct()
        counts = stored(term_counts(docs, vocabulary, id_col, text_col), "term-counts")
        chosen = stored(anchors(wins, counts), "anchors")
        index = stored(postings(docs, chosen.select("term").distinct(), id_col, text_col), "postings")
        bins = starts_of(shifted(index, chosen))
        starts = bins.groupBy("id", "h", "w").agg(F.flatten(F.collect_list("exact")).alias("exact"), F.flatten(F.collect_list("near")).alias("near"))
        asked = starts.join(wins, "w").groupBy("id", "h").agg(F.collect_list(F.struct("exact", "near", "ws", "items")).alias("asked"))
        return keep(asked, "candidates")


def _run_from(words: Column, at: Column, ws: Column) -> Column:
    """The longest proximity match of a window that begins at one place: (n, -size, -start), null if there is none.

    Word by word, ``a`` is how far the window is matched without a missing word and ``b`` how far with one.
    """
    size, lack, slack = F.size(ws), _missing(F.size(ws)), _slack(F.size(ws))
    hit = lambda i, word: F.coalesce(F.get(ws, i) == word, F.lit(False)).cast("int")
    zero = F.struct(F.lit(0).alias("a"), F.lit(1).alias("b"), F.lit(0).alias("q"), F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(state, word):
        a = state["a"] + hit(state["a"], word)
        b = F.greatest(state["b"] + hit(state["b"], word), a + 1)
        q = state["q"] + 1
        n = F.when(lack > 0, b - 1).otherwise(a)
        better = (n >= size - lack) & (n > state["n"]) & (q <= n + slack)
        return F.struct(
            a.alias("a"), b.alias("b"), q.alias("q"), F.when(better, n).otherwise(state["n"]).alias("n"), F.when(better, q).otherwise(state["end"]).alias("end")
        )

    best = F.aggregate(F.slice(words, at + 1, size + slack), zero, step)
    return let(best, lambda x: F.when(x["n"] > 0, F.struct(x["n"].alias("n"), (-x["end"]).alias("size"), (-at).alias("start"))))


def _compared(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with ``n_words``, exact ``spans`` and proximity matches ``near``, and the whole row as ``doc``, which is not read unless
    it is used."""
    text = docs[text_col].cast("string")
    keyed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs[id_col].alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    rows = keyed.join(asked, keyed["id"].eqNullSafe(asked["id"]) & (keyed["h"] == asked["h"]), "left")
    none = F.array().cast("array<struct<start: int, size: int, items: array<string>>>")

    def span(start, size, items):
        return F.struct(start.cast("int").alias("start"), size.cast("int").alias("size"), items.alias("items"))

    def judged(words):
        def exact(c):
            size = F.size(c["ws"])
            return F.filter(c["exact"], lambda s: F.slice(words, s + 1, size) == c["ws"])

        def near(c, at):
            size = F.size(c["ws"])

            def best(s):
                places = F.filter(F.sequence(s - _slack(size), s + 1 + _missing(size)), lambda p: p >= 0)
                begins = F.filter(places, lambda p: F.exists(F.slice(c["ws"], F.lit(1), 1 + _missing(size)), lambda w: w == F.get(words, p)))
                return F.array_max(F.filter(F.transform(begins, lambda p: _run_from(words, p, c["ws"])), lambda r: r.isNotNull()))

            runs = F.array_distinct(F.filter(F.transform(F.array_except(c["near"], at), best), lambda r: r.isNotNull()))
            runs = F.transform(runs, lambda r: span(-r["start"], -r["size"], c["items"]))
            return F.filter(runs, lambda r: ~F.exists(at, lambda s: (s < r["start"] + r["size"]) & (r["start"] < s + size)))

        def both(c):
            return let(exact(c), lambda at: F.struct(F.transform(at, lambda s: span(s, F.size(c["ws"]), c["items"])).alias("spans"), near(c, at).alias("near")))

        def all_of(found, name):
            return F.coalesce(F.array_sort(F.flatten(F.transform(found, lambda f: f[name]))), none).alias(name)

        found = let(F.transform("asked", both), lambda f: F.struct(all_of(f, "spans"), all_of(f, "near")))
        return F.struct(F.size(words).cast("bigint").alias("n_words"), found.alias("found"))

    judged_rows = rows.select("doc", keyed["id"].alias("id"), let(words_of(F.col("text")), judged).alias("j"))
    return judged_rows.select("doc", "id", "j.n_words", "j.found.*")


def matches(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, its number of words ``n_words``, and the matches (start, size, items): exact ones
    ``spans``, proximity matches ``near``."""
    asked = candidates(docs, items, width, id_col, text_col, item_col, item_text_col)
    rows = _compared(docs.select(id_col, text_col), asked, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), "n_words", "spans", "near")


def clean(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows, with all their columns, in which no window of any item occurs, neither as it is nor as a proximity match."""
    asked = candidates(docs, items, width, id_col, text_col, item_col, item_text_col)
    return _compared(docs, asked, id_col, text_col).where((F.size("spans") == 0) & (F.size("near") == 0)).select("doc.*")


def covered(spans: str = "spans") -> Column:
    """Words inside any span: spans in order of their start, each adding what lies beyond the end so far."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(state, span):
        end = span["start"] + span["size"]
        more = F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + more).alias("n"))

    return F.aggregate(spans, zero, add, lambda state: state["n"])


def hit_items(spans: str = "spans") -> Column:
    """Ids of the items with matches, sorted as text."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: s["items"]))))


def report(found: DataFrame, id_col: str = "doc_id", more: tuple[str, ...] = ()) -> DataFrame:
    """Figures per document from :func:`matches`, and the columns ``more``."""
    items = hit_items()
    return found.select(
        id_col, "n_words", covered().alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), *more,
    )


def proximity_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """:func:`report` and the proximity matches: words inside them, number and ids of their items."""
    items = hit_items("near")
    near = F.struct(covered("near").alias("n_near_hit"), F.size(items).cast("bigint").alias("n_near_items"), F.array_join(items, ",").alias("near_items"))
    held = found.select("*", near.alias("proximity"))
    return report(held, id_col, ("proximity.*",))

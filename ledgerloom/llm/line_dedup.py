"""Line de-duplication by an exact set-similarity join.

A line's set holds its distinct words. A line is removed when an earlier line, in the order of document id, document text and
line number, has a set with ``100 * intersection >= percent * union``. Lines of every size are compared, but for those without
a word; ``least_words`` leaves alone lines of fewer distinct words. Whether the earlier line is itself removed does not matter, so the result does not
depend on the order of the work.

Equal sets are one class, represented by its first line. The words of a set are ordered by rarity: how often words of
the same hash bucket stand in all texts (a table of fixed size), then by hash. Two sets that are similar enough share a word among
their first ones, and long ones several among somewhat more of them (prefix filter); sizes must be within the threshold (length
filter), places of a shared word must leave enough words after them (positional filter), and a parity of the words, of 64 bits
or of 128 for long lines, bounds the difference from below.
What is left is verified on the words of the lines themselves. Sets so small that one word more or less is beyond the
threshold (up to three words at 80 percent) match equal sets only, so their class settles them and they are not posted.

A group of near-identical lines would give all its pairs. So each line is first compared with the earliest line that
shares two of its minhashes (with a few early ones, where many lines share them), which near copies have in common however rare their own changed words are; what that settles is not
asked again in the join of all others.

Few lines have near copies. Before a table is shuffled to meet them, a bitmap of their hashes leaves out the rows that cannot
(:func:`marked`); its size is bounded, and what it lets through by chance falls out in the join.

A missing text has no lines, and the row comes back as it is. Documents that lose every line with a word are reported with
no line kept. Repeated rows are one document: their lines are found once, and each row gets the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import WORD, let, noted, stored, workspace

PERCENT = 80
EVERY_LINE = 1
BUCKET_BITS = 16
MARK_BITS = 25
# Pairs of the four minhashes by which lines are gathered.
GATHER = ((0, 1), (2, 3), (0, 2))
# A group with a key in common has so many parts; each part of so many lines or more gives its earliest line to the others.
HEADS = 4
LARGE = 8
# Long lines meet by chance at one rare word, the oftener the more lines there are. So a pair must share one word of its
# prefixes, and one more for every SHARED_STEP words of its smaller set.
SHARED_STEP = 64
# Lines of so many words have 128 bits of parity; 64 bits tell shorter ones apart, and zeros take little room in postings.
LONG = 40
# Turns hashes over for two of the minhashes.
OTHER = 0x5555555555555555


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("bigint").alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))


def _words(line: Column) -> Column:
    """Words of a line. Most lines have no white space but blanks, and are split at them without a pattern."""
    other = [F.contains(line, F.lit(c)) for c in "\t\n\x0b\x0c\r"]
    return F.when(~reduce(Column.__or__, other), F.array_remove(F.split(line, " "), "")).otherwise(F.regexp_extract_all(line, F.lit(WORD), 0))


def rarity(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row with one array: for every hash bucket of words, a level that grows with how often its words stand in all texts.

    The counts are combined in the tasks; the array has ``2 ** BUCKET_BITS`` small numbers, whatever the data.
    """
    # Only the order of the words depends on it, so a tab or the like may stay inside a word here.
    words = docs.select(F.explode(F.split(F.replace(docs[text_col].cast("string"), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(_bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n"))
    level = F.least(F.lit(126), F.floor(F.log2(F.col("n") + 1) * 3)).cast("bigint")
    return _dense(counts.select("b", level.alias("v")), 1 << BUCKET_BITS).select(F.col("values").cast("array<tinyint>").alias("values"))


def _dense(values: DataFrame, size: int) -> DataFrame:
    """One row with one array ``values`` of ``size`` numbers: the ``v`` of every place ``b``, 0 where there is none."""
    every = values.sparkSession.range(size).select(F.col("id").cast("int").alias("b"), F.lit(0).cast("bigint").alias("v"))
    whole = values.unionByName(every).groupBy("b").agg(F.max("v").alias("least"), F.min("v").alias("most"))
    value = F.when(F.col("least") == 0, F.col("most")).otherwise(F.col("least"))
    ordered = whole.agg(F.sort_array(F.collect_list(F.struct("b", value.alias("v")))).alias("k"))
    return ordered.select(F.transform("k", lambda x: x["v"]).alias("values"))


def marked(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test for values of a column like the only one of ``keys``: true for all of these, and for few others.

    One bit per hash, 16 to 32 times as many bits as keys while that is no more than ``2 ** MARK_BITS`` (4 MB).
    """
    bits = min(MARK_BITS, max(10, keys.count().bit_length() + 4))

    def place(key: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(key), 70 - bits).cast("int")

    def bit(key: Column) -> Column:
        at = F.shiftrightunsigned(F.xxhash64(key), 64 - bits).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)

    key = keys[keys.columns[0]]
    held = keys.groupBy(place(key).alias("b")).agg(F.bit_or(bit(key)).alias("v"))
    table = noted(_dense(held, 1 << (bits - 6)), name).scalar()
    return lambda value: F.get(table, place(value)).bitwiseAND(bit(value)) != 0


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def _least_overlap(n: Column, up: int, down: int) -> Column:
    """ceil(n * up / down) in whole numbers."""
    return F.floor((n * up + (down - 1)) / down).cast("int")


def _least_shared(n: Column) -> Column:
    """How many words two similar sets have in common in their prefixes, ``n`` being the smaller size."""
    return (F.floor(n / SHARED_STEP) + 1).cast("int")


def sketched(texts: DataFrame, levels: Column, percent: int = PERCENT, least_words: int = EVERY_LINE) -> DataFrame:
    """Lines of ``texts`` (doc, h, text) with at least ``least_words`` distinct words: class (s1, s2), size n, parity bits, the first words in order of
    rarity, and the gathering keys g."""
    lines = texts.where("text IS NOT NULL").select("doc", "h", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    own = lines.select("doc", "h", "no", F.array_distinct(F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))).alias("t"))
    # The generator keeps the steps apart: a filter on the size would else be pushed below and find the words of every line a
    # second time, and what a lambda works on would be worked out without compiled code.
    own = own.select("doc", "h", "no", F.explode(F.array("t")).alias("t")).where(F.size("t") >= least_words)

    # The table is the value of a one-row subquery, known to every task once; lambdas can only name it as a column. It is used once, so
    # the optimizer puts it in that place; as a column of its own it would be copied with every line.
    def keyed(x):
        level = F.coalesce(F.get("levels", _bucket(x)), F.lit(0).cast("tinyint"))  # never null: arrays of plain numbers are sorted faster
        return F.shiftleft(level.cast("bigint"), 56).bitwiseOR(F.shiftrightunsigned(x, 8))

    own = own.select("doc", "h", "no", "t", levels.alias("levels"))
    own = own.select("doc", "h", "no", "t", F.sort_array(F.transform("t", keyed)).alias("k"), F.transform("t", lambda x: x.bitwiseXOR(F.lit(OTHER))).alias("o"))
    n = F.size("k")
    one = F.lit(1).cast("bigint")

    def parity(keys):
        return F.aggregate(keys, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))))

    upper = F.when(n >= LONG, parity(F.filter("k", lambda x: x.bitwiseAND(F.lit(64)) != 0))).otherwise(F.lit(0).cast("bigint"))
    prefix = F.transform(F.slice("k", F.lit(1), n - _least_overlap(n, percent, 100) + _least_shared(n)), lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    # Four minhashes: the words nearest to the ends of the range of hashes, and to two places inside.
    m = [F.array_min("t"), F.array_max("t"), F.array_min("o"), F.array_max("o")]
    keys = F.array(*(F.hash(F.lit(i), *(m[j] for j in pair)) for i, pair in enumerate(GATHER)))
    # The second half of a class takes sizes and single words only: sets with the same first half differ in these.
    return own.select(
        "doc", "h", "no", F.xxhash64("k").alias("s1"), F.xxhash64(n, *m).alias("s2"), n.alias("n"), parity("k").alias("bits"), upper.alias("upper"),
        prefix.alias("p"), keys.alias("g"),
    )


def _may_match(percent: int, a: str, b: str) -> Column:
    """Length and parity filters for two sets: size and bits columns have the given suffixes.

    ``bits`` are the parity of all words in 64 bits, ``upper`` that of half of them; so two long sets have 128 bits."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    every, half = (F.col(f"{c}{a}").bitwiseXOR(F.col(f"{c}{b}")) for c in ("bits", "upper"))
    both = F.bit_count(half) + F.bit_count(every.bitwiseXOR(half))
    differ = F.when(F.least(na, nb) >= LONG, both).otherwise(F.bit_count(every))
    # With J >= p, |x| + |y| - 2 I <= (100 - p) / (100 + p) (|x| + |y|).
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (differ * (100 + percent) <= (na + nb) * (100 - percent))


def wide_parity(hashes: Column) -> Column:
    """512 parity bits of a set, as eight numbers: the bits in which two sets differ are no more than their differing words."""
    one = F.lit(1).cast("bigint")

    def part(j):
        own = F.filter(hashes, lambda x: x.bitwiseAND(F.lit(7)) == j)
        bit = lambda x: F.call_function("shiftleft", one, F.shiftrightunsigned(x, 3).bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(bit(x)))

    return F.transform(F.sequence(F.lit(0), F.lit(7)), part)


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Ids ``y`` of pairs (x, y) whose lines' words are similar enough."""
    both = noted(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "line-ids")
    places = sets.select("id", "doc", "h", "no").where(marked(both, "line-marks")(F.col("id"))).join(both, "id")
    wanted = stored(places.groupBy("doc", "h").agg(F.collect_list(F.struct("no", "id")).alias("w")), "line-places")
    text = docs[text_col].cast("string")
    texts = docs.select(docs[id_col].cast("bigint").alias("d"), F.xxhash64(text).alias("g"), text.alias("text"))
    held = texts.where(marked(wanted.select("h"), "text-marks")(F.col("g"))).join(wanted, F.col("d").eqNullSafe(F.col("doc")) & (F.col("g") == F.col("h")))
    # The wanted lines are taken out of the text before they become rows, so no row carries a whole text.
    taken = let(F.split("text", "\n", -1), lambda l: F.transform("w", lambda w: F.struct(w["id"].alias("id"), F.get(l, w["no"]).alias("line"))))
    held = held.select(F.explode(taken).alias("w"))
    words = F.array_distinct(_words(F.col("w.line")))
    # Repeated rows of a document give the same line again; one of them is enough.
    line_words = held.select(F.col("w.id").alias("id"), words.alias("t")).dropDuplicates(["id"])
    line_words = stored(line_words.select("id", "t", F.size("t").alias("n"), let(F.transform("t", lambda w: F.xxhash64(w)), wide_parity).alias("w")), "line-words")
    # Long lines pass the short parity often. The wide one is asked before words travel with pairs.
    x, y = (line_words.select(F.col("id").alias(s), F.col("n").alias(f"n{s}"), F.col("w").alias(f"w{s}")) for s in "xy")
    differ = F.aggregate(F.zip_with("wx", "wy", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, c: s + c)
    near = pairs.join(x, "x").join(y, "y").where(differ * (100 + percent) <= (F.col("nx") + F.col("ny")) * (100 - percent))
    pairs = stored(near.select("x", "y"), "line-pairs")
    rows = pairs.join(line_words.select(F.col("id").alias("x"), F.col("t").alias("a")), "x")
    rows = rows.join(line_words.select(F.col("id").alias("y"), F.col("t").alias("b")), "y")
    both_n = F.size(F.array_intersect("a", "b"))
    return rows.where(both_n * 100 >= (F.size("a") + F.size("b") - both_n) * percent).select("y").distinct()


def _gathered(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of sets that share a gathering key and may match, x being the earliest line that has the key."""
    few = sets.select("id", "n", "bits", "upper", F.explode("g").alias("e"))
    # Only lines whose key others have go on.
    several = noted(few.groupBy("e").agg(F.count("*").alias("c")).where("c > 1").select("e"), "line-keys")
    members = stored(few.where(marked(several, "key-marks")(F.col("e"))).join(several, "e"), "line-members")
    # In large groups a line can be far from the earliest one, so there are more to compare with: the earliest of each part.
    earliest = [F.min("id").alias("x"), *(F.min_by(c, "id").alias(f"{c}x") for c in ("n", "bits", "upper"))]
    parts = members.groupBy("e", F.pmod("id", F.lit(HEADS)).alias("part")).agg(*earliest, F.count("*").alias("c"))
    heads = members.groupBy("e").agg(*earliest).unionByName(parts.where(F.col("c") >= LARGE).drop("part", "c"))
    near = members.select("e", F.col("id").alias("y"), *(F.col(c).alias(f"{c}y") for c in ("n", "bits", "upper"))).join(heads, "e")
    return stored(near.where((F.col("x") < F.col("y")) & _may_match(percent, "x", "y")).select("x", "y").distinct(), "line-pairs")


def classes(docs: DataFrame, percent: int, least_words: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The compared lines with their class, and the classes of several lines or with an earlier class that matches:
    their first line and whether there is such a class."""
    levels = stored(rarity(docs, text_col), "rarity").scalar()
    with workspace(docs.sparkSession) as keep:
        whole = stored(sketched(_texts(docs, id_col, text_col), levels, percent, least_words), "lines")
        first = whole.groupBy("s1", "s2").agg(F.min(F.struct("doc", "h", "no", "n", "bits", "upper", "p", "g")).alias("f"), (F.count("*") > 1).alias("more"))
        # Sorted by place, so that ids are in the order of the lines: an earlier line has a smaller id.
        sets = first.select("s1", "s2", "more", "f.*").orderBy("doc", "h", "no").select(F.monotonically_increasing_id().alias("id"), "*")
        sets = keep(sets, "line-sets")
        # Only the sets need the rest of a line.
        lines = keep(whole.select("doc", "h", "no", "s1", "s2"), "line-classes")
    # A set that differs by one word is the nearest one that is not equal.
    pairable = F.col("n") * 100 >= (F.col("n") + 1) * percent
    with workspace(docs.sparkSession) as keep:
        settled = keep(_verified(_gathered(sets.where(pairable), percent), sets, docs, percent, id_col, text_col), "settled")
    # The join of all others: the larger set asks with its longer prefix, the smaller answers with its shorter one.
    maybe = marked(settled, "settled-marks")(F.col("id"))
    asking = sets.where(pairable).select("id", "n", "bits", "upper", "p")
    done = asking.where(maybe).join(settled.select(F.col("y").alias("id"), F.lit(False).alias("open")), "id", "left")
    done = done.select("id", "n", "bits", "upper", "p", F.coalesce("open", F.lit(True)).alias("open"))
    rows = asking.where(~maybe).withColumn("open", F.lit(True)).unionByName(done)
    short = F.slice("p", F.lit(1), F.col("n") - _least_overlap(F.col("n"), 2 * percent, 100 + percent) + _least_shared(F.col("n")))

    def posts(words: Column, side: str, fits: Column) -> DataFrame:
        # Size, place and the open flag share one number, since every posting carries them through the shuffle.
        m = F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("open").cast("bigint"))
        each = rows.where(fits).select("id", "bits", "upper", m.alias("m"), F.posexplode(words).alias("i", "e"))
        return each.select("e", *(F.col(c).alias(f"{c}{side}") for c in ("id", "bits", "upper")), (F.col("m") + F.col("i") * 2).alias(f"m{side}"))

    larger = posts(F.col("p"), "a", (F.col("n") - 1) * 100 >= F.col("n") * percent)
    smaller = posts(short, "b", F.lit(True))
    parts = {f"n{s}": F.shiftright(f"m{s}", 32) for s in "ab"}
    parts |= {f"i{s}": F.shiftright(f"m{s}", 1).bitwiseAND(F.lit((1 << 31) - 1)) for s in "ab"}
    parts |= {f"open{s}": F.col(f"m{s}").bitwiseAND(1) == 1 for s in "ab"}
    joined = larger.join(smaller, "e").withColumns(parts)
    a_later = F.col("ida") > F.col("idb")
    in_order = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ida") > F.col("idb")))
    # Of the first shared words that a pair must have, the last one has all others before it.
    need = _least_shared(F.col("nb"))
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) + need - 1
    places_fit = most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    asked = F.when(a_later, F.col("opena")).otherwise(F.col("openb"))
    pairs = joined.where(in_order & asked & places_fit & _may_match(percent, "a", "b"))
    x, y = F.when(a_later, F.col("idb")).otherwise(F.col("ida")), F.when(a_later, F.col("ida")).otherwise(F.col("idb"))
    shared = pairs.groupBy(x.alias("x"), y.alias("y"), need.alias("need")).agg(F.count("*").alias("c"))
    pairs = stored(shared.where("c >= need").select("x", "y"), "line-pairs")
    rest = _verified(pairs, sets, docs, percent, id_col, text_col)
    later = settled.unionByName(rest).distinct().select(F.col("y").alias("id"), F.lit(True).alias("near"))
    later = noted(later, "later")
    # Only these have lines to remove.
    maybe = F.col("more") | marked(later.select("id"), "later-marks")(F.col("id"))
    some = sets.select("id", "s1", "s2", "doc", "h", "no", "more").where(maybe).join(later, "id", "left").where("more OR near")
    return lines, some.select("s1", "s2", "doc", "h", "no", F.coalesce("near", F.lit(False)).alias("near"))


def decisions(
    docs: DataFrame, percent: int = PERCENT, least_words: int = EVERY_LINE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc, h, removed, n_repeated, n_similar): for each document with removed lines their numbers, and how many of them
    repeat a set of an earlier line or are similar to an earlier line of another set."""
    with workspace(docs.sparkSession) as keep:
        lines, sets = classes(docs, percent, least_words, id_col, text_col)
        return keep(_removed(lines, sets), "line-decisions")


def _removed(lines: DataFrame, sets: DataFrame) -> DataFrame:
    its = sets.select("s1", "s2", F.struct("doc", "h", "no").alias("first"), "near")
    each = lines.select("doc", "h", "no", "s1", "s2").join(its, ["s1", "s2"])
    repeated = ~F.struct("doc", "h", "no").eqNullSafe(F.col("first"))
    gone = each.select("doc", "h", "no", repeated.alias("repeated"), "near").where("repeated OR near")
    # Repeated rows of a document say the same; a set takes each line once.
    found = gone.groupBy("doc", "h").agg(F.sort_array(F.collect_set(F.struct("no", "repeated"))).alias("f"))
    n_repeated = F.size(F.filter("f", lambda x: x["repeated"])).cast("bigint")
    return found.select(
        "doc", "h", F.transform("f", lambda x: x["no"]).alias("removed"), n_repeated.alias("n_repeated"),
        (F.size("f").cast("bigint") - n_repeated).alias("n_similar"),
    )


def report(docs: DataFrame, percent: int = PERCENT, least_words: int = EVERY_LINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_lines, n_removed, n_repeated, n_similar and the numbers of removed lines, comma-joined."""
    found = decisions(docs, percent, least_words, id_col, text_col)
    text = docs[text_col].cast("string")
    n_lines = F.when(text.isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("g"), n_lines.cast("bigint").alias("n_lines"))
    out = rows.join(found, F.col("id").cast("bigint").eqNullSafe(F.col("doc")) & (F.col("g") == F.col("h")), "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("removed").cast("bigint"), zero).alias("n_removed"),
        F.coalesce("n_repeated", zero).alias("n_repeated"), F.coalesce("n_similar", zero).alias("n_similar"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )


def deduplicated(docs: DataFrame, percent: int = PERCENT, least_words: int = EVERY_LINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, their texts without the removed lines; rows left without a word are dropped, unless
    nothing was removed from them."""
    found = decisions(docs, percent, least_words, id_col, text_col).select("doc", "h", "removed")
    text = docs[text_col].cast("string")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].cast("bigint").alias("d"), F.xxhash64(text).alias("g"), text.alias("text"))
    joined = rows.join(found, F.col("d").eqNullSafe(F.col("doc")) & (F.col("g") == F.col("h")), "left").select("row", "text", "removed")
    # The numbers of the kept lines come from one hashed difference, so a text of very many lines takes time in proportion.
    kept = let(
        F.split("text", "\n", -1),
        lambda l: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(l) - 1), "removed"), lambda i: F.get(l, i)), "\n"),
    )
    out = joined.select("row", "removed", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept).alias("text"))
    out = out.where(F.col("removed").isNull() | F.col("text").rlike(WORD))
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))

"""Spelling variants, conversation prefixes and license scans against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import license_scan, prefix_trie, spelling

DOCS = "doc_id long, text string, id long, word string, n int, spans string, row string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, "w", 2, "s", "r") for i, t in texts], DOCS).repartition(3)


# ------------------------------------------------------------------ spelling variants


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(texts):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out, form = {}, {}
    for w, n in words.items():
        near = [x for x in words if distance_one(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = (n, len(near), words[form[w]] if form[w] else None)
    rows = set()
    for w, (n, near, form_n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, near, form_n))
    return rows


def edited_word(rng, word):
    at = rng.randrange(len(word) + 1)
    return rng.choice([word[:at] + rng.choice("abé") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("abÿ") + word[at + 1 :]])


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(3)
    base = ["".join(rng.choice("abné") for _ in range(rng.randrange(4, 11))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ÀbcdeÉ"]
    words = [w for w in base for _ in range(rng.choice([3, 9, 40]))]
    # Chains: each further spelling is rarer by half, so forms follow each other to one root.
    chain = "commonword"
    for n in (300, 90, 30, 10, 3):
        words += [chain] * n
        chain += "q"
    words += [edited_word(rng, w) for w in rng.choices(base, k=900)]
    rng.shuffle(words)
    texts = [(i, " ".join(words[i * 40 : i * 40 + 40]).title() if i % 3 else "-".join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    texts += [(None, "missing missing missing missin missin missin"), (7, None), (8, ""), (9, "x" * 3000 + " " + "ab" * 2), (9, "x" * 3000), (9, "x" * 3000)]
    return texts + texts[:2]


def test_variants_equal_brute_force(spark, spelled):
    got = {tuple(r) for r in spelling.variants(docs_of(spark, spelled)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = variants_by_hand(spelled)
    assert got == want
    assert any(form and form != root for _, form, root, *_ in want)


def test_words_of_a_long_text(spark, spelled):
    text = " ".join(t for _, t in spelled if t)
    long = [(1, (text + " ") * (1 + 2_500_000 // len(text)))]
    assert {tuple(r) for r in spelling.word_counts(docs_of(spark, long)).collect()} == {(w, n) for w, _, _, n, *_ in variants_by_hand(long)}


def test_every_word_pair_of_a_small_alphabet(spark):
    """All words of five and six letters over two: dense neighbourhoods and runs of equal letters."""
    words = [format(i, f"0{k}b").replace("0", "a").replace("1", "b") for k in (5, 6) for i in range(2**k)]
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"))
    got = [frozenset((r.worda, r.wordb)) for r in pairs.collect()]
    want = {frozenset((a, b)) for a in words for b in words if distance_one(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_posted_rows_and_links_are_not_broadcast(spark, monkeypatch):
    # A small file of words is posted as many rows, and the links are as many as the words: neither is copied through the driver.
    plans, stored = [], spelling.stored
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()

    def seen(df, name):
        plans.append((name, plan(df)))
        return stored(df, name)

    monkeypatch.setattr(spelling, "stored", seen)
    links = spark.createDataFrame([("alphass", "alphas"), ("alphas", "alpha")], "word string, up string")
    assert {tuple(r) for r in spelling._ends(links).collect()} == {("alphass", "alpha"), ("alphas", "alpha")}
    joins = [p for _, p in plans if "Join" in p]
    joins.append(plan(spelling.near_pairs(spark.createDataFrame([("alpha", 9), ("alphas", 3)], "word string, n bigint"))))
    assert len(joins) > 1 and not any("Broadcast" in p for p in joins)


def test_variants_of_nothing(spark):
    assert spelling.variants(docs_of(spark, [])).collect() == []
    assert spelling.variants(docs_of(spark, [(1, None), (None, "")])).collect() == []


# ------------------------------------------------------------------ conversation prefixes

TURNS = "conv_id long, turn long, role string, text string, conv string, pos int, t1 string, block int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "t", 2) for r in rows], TURNS).repartition(4)


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c >= 0 else -1)
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def trie_by_hand(paths):
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows = set()
    for node, its in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        ends = [str(c) for c in its if len(paths[c]) == len(node)]
        rows.add((
            its[0], len(node), members[node[:-1]][0] if node else None, len(its), len(children[node]), sum(not children[n] for n in subtree),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in subtree if n), hashlib.sha256(",".join(ends).encode()).hexdigest(), len(ends),
        ))
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_ends"]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(5)
    rows = []
    for c in [*range(-3, 60), *range(300, 330), 1000, 1001]:
        for turn in range(rng.choice([1, 1, 2, 3, 8, 9, 20])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "ñandú " * 3])))
    # Long conversations with a common stretch of more than two blocks, one row by row the prefix of the other.
    for c, n in ((2000, 40), (2001, 27), (2002, 40), (2003, 16), (2004, 8)):
        rows += [(c, turn, "user", f"line {turn % 9}") for turn in range(n)]
    rows += [(5, 0, "user", "again")] * 3 + [(6, None, None, None), (6, None, "user", None), (None, 0, "user", "nobody"), (None, None, None, None)]
    return rows


def test_trie_equals_brute_force(spark, talk):
    turns = prefix_trie.ordered_turns(turns_of(spark, talk))
    got = [tuple(r) for r in prefix_trie.trie(prefix_trie.with_shared_heads(turns)).select(COLUMNS).collect()]
    assert len(got) == len(set(got))
    assert set(got) == trie_by_hand(rebuilt_by_hand(talk))


def test_trie_of_conversations_as_they_are(spark, talk):
    rows = [r for r in talk if r[0] is not None and r[0] >= 2000 and r[1] is not None]
    paths = defaultdict(list)
    for c, _, role, text in sorted(rows):
        paths[c].append((role, text))
    turns = prefix_trie.as_they_are(prefix_trie.ordered_turns(turns_of(spark, rows)))
    assert {tuple(r) for r in prefix_trie.trie(turns).select(COLUMNS).collect()} == trie_by_hand(paths)


def test_trie_of_a_hot_conversation_and_a_hot_first_turn(spark):
    rows = [(1, i, "user", f"t{i % 7}") for i in range(500)] + [(c, 0, "system", "hello") for c in range(2000, 2600)]
    turns = prefix_trie.as_they_are(prefix_trie.ordered_turns(turns_of(spark, rows)))
    nodes = {(r.conv_id, r.depth): r for r in prefix_trie.trie(turns).collect()}
    assert len(nodes) == 1 + 500 + 1
    hot = nodes[2000, 1]
    assert (hot.n_convs, hot.n_ends, hot.saved_tokens) == (600, 600, 599 * 5)
    assert hot.ends_sha256 == hashlib.sha256(",".join(map(str, range(2000, 2600))).encode()).hexdigest()
    assert (nodes[1, 0].n_convs, nodes[1, 0].n_children, nodes[1, 0].n_leaves) == (601, 2, 2)
    assert nodes[2000, 1].parent_conv_id == 1 and nodes[1, 500].parent_conv_id == 1


def test_trie_of_nothing(spark):
    turns = prefix_trie.ordered_turns(turns_of(spark, []))
    assert prefix_trie.trie(prefix_trie.with_shared_heads(turns)).collect() == []


# ------------------------------------------------------------------ license scans


def variants_of(rng, items):
    """A wording that the items accept."""
    out = []
    for kind, *given in items:
        if kind == "word":
            out.append(given[0].decode())
        elif kind == "any":
            out += [rng.choice(["acme", "foo", "license"]) for _ in range(rng.randint(*given))]
        elif kind == "optional":
            out += variants_of(rng, given[0]) if rng.random() < 0.5 else []
        else:
            out += variants_of(rng, rng.choice(given[0]))
    return out


def ends_of(items, words, at):
    """All places behind ``at`` to which the items can lead, by trying every choice."""
    places = {at}
    for kind, *given in items:
        if kind == "word":
            places = {p + 1 for p in places if p < len(words) and words[p] == given[0].decode()}
        elif kind == "any":
            places = {p + k for p in places for k in range(given[0], given[1] + 1) if p + k <= len(words)}
        elif kind == "optional":
            places |= set().union(*(ends_of(given[0], words, p) for p in places)) if places else set()
        else:
            places = set().union(*(ends_of(c, words, p) for p in places for c in given[0])) if places else set()
    return places


def scanned_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    spans = set()
    for label, markup in (*license_scan.PHRASES, *license_scan.TEMPLATES):
        latest = {}
        for at in range(len(words)):
            for end in ends_of(license_scan.parsed(markup), words, at):
                latest[end] = at
        spans |= {(label, at, end) for end, at in latest.items()}
    names = {label for label, _ in license_scan.PHRASES}
    base = [s for s in spans if s[0] in names]
    starts = [s[1] for s in base]
    score = 0.0 if not spans else 0.5 if len(base) == len(spans) else 1.0
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({s[0] for s in base})),
        ",".join(sorted({s[0] for s in spans})), score, spans,
    )


@pytest.fixture(scope="module")
def licensed():
    rng = random.Random(11)
    texts = [(0, None), (1, ""), (2, "--- \n"), (3, "MIT License"), (3, "MIT License"), (None, "the mit-license, Apache License; É General\nPublic LICENSE mit license")]
    for i in range(120):
        label, markup = rng.choice(license_scan.TEMPLATES)
        words = variants_of(rng, license_scan.parsed(markup))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "other"
        if i % 5 == 0:
            del words[rng.randrange(len(words))]
        text = " ".join(rng.choices(["lorem", "under", "the", "MIT", "license", "licensed"], k=30)) + ", " + "; ".join(words).upper() + " the end"
        texts.append((10 + i, text))
    return texts


def result(rows):
    return Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, frozenset((s.label, s.first, s.end) for s in r.spans))
        for r in rows
    )


def test_licenses_equal_brute_force(spark, licensed):
    got = result(license_scan.scan(docs_of(spark, licensed)).collect())
    want = Counter((doc, *(frozenset(v) if isinstance(v, set) else v for v in scanned_by_hand(text))) for doc, text in licensed)
    assert got == want
    labels = {label for row in got for label in row[6].split(",")}
    assert labels >= {label for label, _ in license_scan.TEMPLATES}


def test_few_states_give_the_same(licensed, monkeypatch):
    automaton = license_scan.Automaton((*license_scan.PHRASES, *license_scan.TEMPLATES))
    plain, texts = license_scan.Scanner(automaton), [(t or "").encode() for _, t in licensed]
    want = [plain.places(t) for t in texts]
    monkeypatch.setattr(license_scan, "MAX_STATES", 3)
    assert [license_scan.Scanner(automaton).places(t) for t in texts] == want


def test_places_across_pieces():
    automaton = license_scan.Automaton((("x", "begin <<var;words=0-5>> the end"),))
    filler = "w " * ((1 << 20) // 2 - 2)
    total, found = license_scan.Scanner(automaton).places((filler + "begin a b the end " + "y" * (3 << 20) + " begin the end").encode())
    first = len(filler) // 2
    assert (total, found) == (first + 9, [(0, first, first + 5), (0, first + 6, first + 9)])


@pytest.mark.parametrize("markup", ["<<beginOptional>>a<<endOptional>> b", "a <<var;words=1-2>>", "a <<beginOptional>> b c", "a <<endOptional>> b", "a <<what>> b", "", "a <<var;words=3-1>> b"])
def test_templates_that_are_refused(markup):
    with pytest.raises(ValueError):
        license_scan.parsed(markup)


def test_licenses_of_nothing(spark):
    assert license_scan.scan(docs_of(spark, [])).collect() == []

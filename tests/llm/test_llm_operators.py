"""The text operators against brute force on small tables with missing, empty, long, tied and repeated rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chat_format, components, decontamination, line_dedup, minhash, mixing, quality_rules, queries, secrets, token_counts, toxicity, url_filter,
)
from ledgerloom.llm.queries import vocabulary_path

WORDS = [f"w{i}x" for i in range(300)]
# Extra columns whose names the operators use inside.
EXTRA = "id long, h string, n int, key string, words string, text2 string, doc string, row string, levels int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, n):
    words = text.split(" ")
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text) rows: families of near copies, repeated lines, secrets, benchmark passages and odd rows."""
    rng = random.Random(7)
    base, long_line = sentence(rng, 120), sentence(rng, 40)
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, base), (6, base), (6, base), (7, "Of.")]
    out += [(10 + i, edited(rng, base, 2 + i % 9)) for i in range(60)]
    out += [(100 + i, "\n".join([sentence(rng, 30), long_line, edited(rng, long_line, i % 4), "Of.", sentence(rng, 8)])) for i in range(12)]
    out += [(200, "x " * 30000 + sentence(rng, 200)), (201, "\n".join([sentence(rng, 60)] * 5)), (None, base), (None, None)]
    out += [(300, 'password = "hunter22!" token: abc AKIA' + "Z9" * 9 + " " + "0af9" * 8 + " é key Zx81kQp0LmN3vRt7Yw2e end")]
    out += [(301, "don't <|endoftext|> stop  日本語" + " " * 50 + "a" * 400), (302, "### *** " * 60)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if (i or 0) % 7 == 3 else f"s{(i or 0) % 4}", len(t or ""), 1, "h", 2, "k", "w", "t", "d", "r", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, texts):
    return spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in texts if i is not None], "doc_id long, quality int, toxic int")


def test_token_counts(docs, empty, texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    got = sorted(tuple(-1 if v is None else v for v in r) for r in token_counts.token_counts(docs, vocabulary_path()).collect())
    want = []
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((-1 if i is None else i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want)
    assert token_counts.token_counts(empty, vocabulary_path()).count() == 0


def test_long_pre_tokens_merge_like_short_ones():
    ranks, whole, _ = token_counts.vocabulary(vocabulary_path())
    rng = random.Random(3)
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_path())
    for n in (150, 199, 200, 201, 900):
        text = "".join(rng.choice("abcdefghthe") for _ in range(n))
        assert token_counts.merge_count(list(text), ranks) == len(library.encode(text).ids)
    assert "the" in whole


def brute_url(url, model):
    """Host, path, rule and verdict of one url, and its score, written out plainly."""
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + tail
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    grams = set()
    for side, text in ((b"h", f"^{host}$".encode()), (b"p", f"^{path}$".encode())):
        grams |= {zlib.crc32(text[i : i + n], zlib.crc32(side) + n) % url_filter.DIMENSIONS for n in (2, 3, 4, 5) for i in range(len(text) - n + 1)}
    s = sum(model[0][g] for g in grams) / math.sqrt(max(1, len(grams))) + model[1]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    verdict = best[2] if best else "block" if s >= 0 else "allow"
    return host, path, best and best[0] + best[1], verdict, 1 / (1 + math.exp(-max(-35, min(35, s))))


def test_url_filter_equals_brute_force(spark):
    odd = [None, "", "://", "http://", "no scheme/en/", "HTTP://CASINO-Ä.Example.ORG/en/?a://b", "http://a.org\n/x\ny#z", "http://b.net/" + "casino-bonus/" * 20000,
           "x://y://z.com/", "http://tie.net/es/", "http://tie.net/es/"]
    pages = spark.createDataFrame([(i if i != 3 else None, u, "extra") for i, u in enumerate(odd)], "page_id long, url string, path string")
    both = pages.unionByName(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", F.lit("x").alias("path")))
    known = url_filter.known_urls(spark)
    model = url_filter.fit([tuple(r) for r in known.collect()])
    got = url_filter.judge(both, known).collect()
    key = lambda r: (repr(r[0]), r[1], r[2], repr(r[3]), r[4], round(r[5], 9))
    assert sorted(map(key, got)) == sorted(key((r.page_id, *brute_url(r.url, model))) for r in both.collect())


def test_url_labels_teach_hosts_held_out(spark):
    rows = [tuple(r) for r in url_filter.known_urls(spark).collect()]
    assert len(set(rows)) == len(rows) <= 200 and len({r[:2] for r in rows}) == len(rows)
    right = 0
    for fold in range(5):
        held = [r for r in rows if zlib.crc32(r[0].encode()) % 5 == fold]
        w, b = url_filter.fit([r for r in rows if zlib.crc32(r[0].encode()) % 5 != fold])
        for host, path, verdict in held:
            at = url_filter.features(host, path)
            right += (w[at].sum() / math.sqrt(len(at)) + b >= 0) == (verdict == "block")
    assert right >= 0.68 * len(rows)


def test_url_filter(spark):
    urls = ["http://a.com/x", "https://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://x.net/es/1?q", "x.net/es/", None, "", "ftp://q.org", "http://com/",
            "http://notcom.org/en/", "http://u.example.com/en/a#b", "http://example.com"]
    pages = spark.createDataFrame([(i, u, 5) for i, u in enumerate(urls * 2)], "page_id long, url string, host int")
    got = {r.page_id: r for r in url_filter.judge(pages, url_filter.known_urls(spark)).collect()}
    assert len(got) == len(urls) * 2
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("example.com", "/en/1", "example.com/en/", "block")
    assert (got[2].rule, got[2].verdict) == ("www.example.com/en/", "allow")
    assert [got[i].rule for i in (0, 3, 4, 5, 7, 8, 10, 11)] == ["com/", "net/es/", None, None, None, "com/", "example.com/en/", None]
    assert (got[5].host, got[5].path) == ("", "")
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_filter.judge(pages.limit(0), url_filter.known_urls(spark)).count() == 0
    nothing = url_filter.known_urls(spark).limit(0)
    assert {r.verdict for r in url_filter.judge(pages, nothing).collect() if r.rule is None} == {"allow"}


def test_url_model_tells_hosts_apart(spark):
    rows = [(f"spam{i}.test", "/buy", "block") for i in range(60)] + [(f"news{i}.test", "/read", "allow") for i in range(60)]
    known = spark.createDataFrame(rows, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://{'spam' if i % 2 else 'news'}{i}.test/{'buy' if i % 2 else 'read'}") for i in range(100, 200)], "page_id long, url string")
    got = url_filter.judge(pages, known, rules=()[:0] or (("none.example", "/", "allow"),)).collect()
    assert all((r.verdict == "block") == bool(r.page_id % 2) for r in got)


TURNS = [(1, 0, "system", "Be <|end|> good"), (1, 1, "user", "[INST] hi <\\|turn|>"), (1, 2, "assistant", "a " * 700), (1, 3, "user", None), (1, 4, "assistant", "yes\n</s>"),
         (2, 0, "user", "q"), (2, 0, "user", "q"), (2, 1, None, "x"), (None, None, "assistant", ""), (3, 5, "assistant", "<|turn|><|turn|>\\<|text|>")]


def test_chat_format(spark):
    turns = spark.createDataFrame([(*t, 9) for t in TURNS], "conv_id long, turn long, role string, text string, no int")
    wins = chat_format.windows(turns, budget=100, history=40)
    got = {r.conv_id: r for r in chat_format.digests(wins).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted(((t[1] if t[1] is not None else -1), t[2] or "", t[3] or "") for t in TURNS if t[0] == conv)
        learnt = "".join(t for _, r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    for w in wins.collect():
        assert w.tokens <= 100 or w.n_turns == 1
        if w.conv == 1 and w.first > 1:
            assert w.formatted.startswith("<|turn|>system<|text|>Be <\\|end|> good<|end|>")
    assert chat_format.digests(chat_format.windows(turns.limit(0))).count() == 0


@pytest.mark.parametrize("budget", [(3, 2), (2, 1), (1, 2)])
def test_mixing(docs, empty, texts, budget):
    got = mixing.mix(docs, budget=budget).collect()
    again = mixing.mix(docs.repartition(1), budget=budget).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for i, t in texts:
        sizes[None if (i or 0) % 7 == 3 else f"s{(i or 0) % 4}"] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, open_ones = sum(sizes.values()) * budget[0] / budget[1], {}, set(order)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        over = {s for s in open_ones if share[s] > 2 * sizes[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        open_ones -= over
        if not open_ones:
            break
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
        assert 0 <= r.taken <= 2 * r.size
    for s in order:
        rows = [r for r in got if r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6]
        # Whole documents only: what is missing is less than a document that was left out.
        missing = target[s] - sum(r.taken for r in rows)
        assert rows and all(r.taken in (r.whole * r.size, (r.whole + 1) * r.size) for r in rows)
        assert -1e-6 <= missing < max([r.size for r in rows if r.taken == r.whole * r.size], default=0) + 1
    assert mixing.mix(empty).count() == 0


def test_repetitions_hold_the_taken_words(docs, empty):
    rows = mixing.repetitions(docs)
    assert rows.columns == [*docs.columns, "repetition"]
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert rows.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken
    assert mixing.repetitions(empty).count() == 0
    # Every repetition is a whole document.
    assert rows.join(docs, ["doc_id", "text"], "left_anti").where("doc_id IS NOT NULL AND text IS NOT NULL").count() == 0


def test_repetitions_replace_a_column_of_that_name(docs):
    rows = mixing.repetitions(docs.withColumn("repetition", F.lit("x")))
    assert rows.columns == [*docs.columns, "repetition"] and rows.schema["repetition"].dataType.simpleString() == "bigint"


def test_mixing_of_a_hot_source(spark):
    """One source with nearly all rows, one with a single long document."""
    words = [(i, "w " * (1 + i % 40), "hot") for i in range(3000)] + [(9000, "w " * 5000, "long"), (9001, "w", None)]
    got = mixing.mix(spark.createDataFrame(words, "doc_id long, text string, source string").repartition(5)).collect()
    hot = [r for r in got if r.doc_id < 9000]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 1


def test_toxic_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, "a b")] * 500 + [(1, "z"), (2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert sorted((r.id, r.toxic) for r in toxicity.sample(docs, labels).collect()) == [(1, 1), (2, 0), (3, 0)]


def test_a_document_of_very_many_lines(spark):
    text = "\n".join(["Of.", "one two three"] * 30000 + ["last line here"])
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, row string")
    assert [r.text for r in line_dedup.deduplicated(docs).collect()] == ["Of.\none two three\nlast line here"]


def brute_measures(text):
    words = (text or "").encode().split()
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = defaultdict(int)
    for run in runs:
        counts[run] += 1
    inside = {i + j for i, run in enumerate(runs) if counts[run] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_quality_rules(docs, empty, texts):
    rows = quality_rules.ledger(docs)
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows.collect())
    assert got == sorted((repr(i), *brute_measures(t)) for i, t in texts)
    for r in rows.collect():
        assert (r.failed & 3 == 0) == (r.n_words >= 50 and 100 * r.n_repeat_words <= 50 * r.n_words)
    kept = quality_rules.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == rows.where(quality_rules.passes("v2")).count()
    table = {(r["policy"], r["rule"]): r for r in quality_rules.ablations(rows).collect()}
    failed = [r.failed for r in rows.collect()]
    assert table["base", "few_words"].n_kept_without == sum(f & 2 == 0 for f in failed)
    assert quality_rules.ledger(empty).count() == 0


def test_decontamination(spark, docs, empty, texts):
    rng = random.Random(5)
    base = next(t for i, t in texts if i == 5)
    items = [(1, base), (2, " ".join(base.split()[30:36])), (3, sentence(rng, 12)), (4, None), (5, "..."), (12, "ONE"), (6, "x x x x x x x x x x x")]
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, ws string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - 9) if w else 0):
            grams[tuple(w[at : at + 10])].add(str(i))
    want = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for at in range(len(w) - n + 1):
                if (who := grams.get(tuple(w[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= who
        want.append((repr(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    got = decontamination.report(decontamination.matches(docs, bench)).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == sorted(want)
    left = decontamination.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not w[-1] for w in want)
    assert decontamination.matches(empty, bench).count() == 0
    assert decontamination.matches(docs, bench.limit(0)).where(F.size("spans") > 0).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "aa bb cc dd ee"), (2, "aa bb zz cc dd ee"), (3, "ee zz zz zz zz zz aa zz zz zz zz bb")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "aa bb cc dd ee")], "item_id long, text string")
    wins = decontamination.windows(bench)
    counts = decontamination.term_counts(docs, wins.select(F.explode("ws").alias("term")).distinct())
    chosen = decontamination.anchors(wins, counts)
    lists = decontamination.shifted(decontamination.postings(docs, chosen.select("term").distinct()), chosen)
    assert [r.id for r in decontamination.intersect(lists).collect()] == [1]
    assert [r.id for r in decontamination.proximity(lists, 2).collect()] == [2]


def test_proximity_matches_beside_exact_spans(spark):
    rng = random.Random(8)
    passage = [f"p{i}q" for i in range(40)]
    every = lambda edit: " ".join(w for i, word in enumerate(passage) for w in (edit(i, word) if i % 8 == 3 else [word]))
    moved = list(passage)
    for at in range(3, 36, 8):
        moved[at], moved[at + 1] = moved[at + 1], moved[at]
    texts = [" ".join(passage), every(lambda i, w: [w, f"in{i}x"]), every(lambda i, w: []), every(lambda i, w: [f"re{i}x"]), " ".join(moved),
             " ".join(rng.sample(passage, 40)), "p4q p5q", sentence(rng, 60) + " " + every(lambda i, w: [w, "x"]) + " " + sentence(rng, 60), None]
    rows = [(i, t) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(9, " ".join(passage))], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert [i for i in got if got[i].spans] == [0] and sorted(i for i in got if got[i].near) == [1, 2, 3, 4, 7]
    for i in (1, 2, 3, 4, 7):
        words = texts[i].split(" ")
        for m in got[i].near:
            assert m["items"] == ["9"] and 9 <= m.size <= 13
            run = words[m.start : m.start + m.size]
            assert sum(w in passage for w in run) >= 9 and run[0] in passage and run[-1] in passage
    # Words that no other training text has: the replaced word of each window is unknown.
    alone = decontamination.matches(spark.createDataFrame(rows[3:4], "doc_id long, text string"), bench).collect()
    assert alone[0].near and not alone[0].spans
    assert [r.doc_id for r in decontamination.clean(spark.createDataFrame(rows, "doc_id long, text string"), bench).orderBy("doc_id").collect()] == [5, 6, 8]


def brute_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    base = sorted(out)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        run = m[0]
        if len(run) < 20 or re.search(secrets.ALLOWED.replace("(?i)", ""), run, re.I | re.A) or any(b[0] < m.end() and m.start() < b[2] for b in base):
            continue
        least = 2.9 if re.fullmatch("[0-9a-fA-F]*", run) else 3.6
        hot = [i for i in range(len(run) - 19) if -sum(c / 20 * math.log2(c / 20) for c in (run[i : i + 20].count(x) for x in set(run[i : i + 20]))) >= least]
        if hot:
            out.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
    return base, sorted(out)


def test_secrets(spark, docs, empty, texts):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
    odd = ["token=token:abcdefgh", "TOKEN == 'abcdef' secret:é apikey=longenough passwd:short", "AKIA" + "A" * 15, "AKIA" + "AKIA" * 5, "é" * 5 + "0123456789abcdef" * 2,
           "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "".join(rng.choice(letters) for _ in range(300))]
    odd += [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(10, 60))) for _ in range(20)) for _ in range(20)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = secrets.scan(rows).collect()
    every = [*texts, *((1000 + i, t) for i, t in enumerate(odd))]
    flat = lambda spans: [(s.start, s.kind, s.end) for s in spans]
    assert sorted((repr(r.doc_id), flat(r.base), flat(r.spans)) for r in got) == sorted((repr(i), *brute_secrets(t)) for i, t in every)
    assert secrets.report(secrets.scan(empty)).count() == 0


def test_toxicity(spark, docs, empty, labels):
    rng = random.Random(9)
    rows = [(i, sentence(rng, 60) + (" vile brute" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    learnt = known.where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.train(known.select("doc_id", "text"), learnt.select("doc_id", "toxic"))
    assert 0 < len(model.index) < 5000
    got = {r.doc_id: r.score for r in toxicity.score(known, model).collect()}
    assert {r[0] for r in known.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()} == {i for i, _, _ in rows if fold(i)}
    right = [(got[i] >= 0.5) == bool(t) for i, _, t in rows if fold(i)]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(empty, model).count() == 0
    unlearnt = toxicity.train(empty, labels)
    assert {r.score for r in toxicity.score(docs, unlearnt).collect()} == {0.5}


def brute_lines(texts, percent=80, least=5):
    seen_docs, lines = set(), []
    for i, t in texts:
        if (i, t) in seen_docs:
            continue
        seen_docs.add((i, t))
        lines += [((i is not None, i or 0), n, frozenset(x.encode().split()), (i, t)) for n, x in enumerate((t or "").split("\n")) if t is not None]
    lines = [x for x in sorted(lines, key=lambda x: x[:2]) if len(x[2]) >= least]
    gone = defaultdict(list)
    for k, (_, n, words, doc) in enumerate(lines):
        if any(len(words & w) * 100 >= percent * len(words | w) for _, _, w, _ in lines[:k]):
            gone[doc].append(n)
    return gone


def test_line_dedup(docs, empty, texts):
    gone = brute_lines(texts)
    got = line_dedup.report(docs, least_words=5).collect()
    want = sorted((repr(i), 0 if t is None else t.count("\n") + 1, ",".join(map(str, gone[i, t]))) for i, t in texts)
    assert sorted((repr(r.doc_id), r.n_lines, r.removed_lines) for r in got) == want
    left = line_dedup.deduplicated(docs, least_words=5)
    assert left.columns == docs.columns
    words = lambda t: bool((t or "").encode().split())
    kept = lambda i, t: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t]) if gone[i, t] else t
    assert sorted(map(repr, left.select("doc_id", "text").collect())) == sorted(
        f"Row(doc_id={i!r}, text={kept(i, t)!r})" for i, t in texts if not gone[i, t] or words(kept(i, t))
    )
    assert line_dedup.report(empty).count() == 0


def test_short_lines_are_deduplicated(spark, tmp_path):
    rows = [(1, "Of.\nb c\n\nd e f g\none two three four"), (2, "Of.\nd e f g h\nc b\n\nb c d"), (3, "five six\nOf.\none two three four"), (4, "one two three\ni\ni i\n\n"), (5, "Of.")]
    place = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{place}/documents.parquet")
    gone = brute_lines(rows, least=1)
    assert gone == {(2, rows[1][1]): [0, 1, 2], (3, rows[2][1]): [1, 2], (4, rows[3][1]): [2], (5, "Of."): [0]}
    got = {r.doc_id: r.removed_lines for r in queries.QUERIES["op9_line_dedup"](spark, place).collect()}
    assert got == {i: ",".join(map(str, gone[i, t])) for i, t in rows}
    left = dict(corpus_pipeline.lines(spark, spark.read.parquet(f"{place}/documents.parquet"), place).collect())
    assert left == {1: rows[0][1], 2: "\nb c d", 3: "five six", 4: "one two three\ni\n\n"}


def test_long_lines_at_the_threshold(spark):
    """Lines of up to 300 words, frequent and rare ones, replaced, dropped and added up to and just beyond the threshold."""
    rng = random.Random(11)
    zipf = [f"z{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    texts = []
    for i in range(24):
        base = list(dict.fromkeys(rng.choices(zipf, weights, k=[30, 64, 65, 130, 260, 520][i % 6])))
        lines = [base]
        for share in (0.05, 0.105, 0.11, 0.115, 0.12, 0.19, 0.2, 0.21):
            line, n = list(rng.choice(lines[-2:])), max(1, round(len(base) * share))
            way = rng.randrange(3)
            if way < 2:  # replaced or dropped
                gone = set(rng.sample(line, min(n, len(line) - 1)))
                line = [w for w in line if w not in gone]
            if way != 1:
                line += [rng.choice([f"q{rng.randrange(10**6)}", rng.choice(zipf)]) for _ in range(n)]
            rng.shuffle(line)
            lines.append(line)
        texts += [(1000 * k + i, " ".join(line)) for k, line in enumerate(lines)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    gone = brute_lines(texts, least=1)
    assert 60 < len(gone) < len(texts) - 40
    got = {r.doc_id: r.removed_lines for r in line_dedup.report(rows).collect()}
    assert got == {i: ",".join(map(str, gone[i, t])) for i, t in texts}


def test_near_copies_with_words_of_their_own_give_few_pairs(spark, monkeypatch):
    """The rarest words of a near copy are its own, so they do not lead to the first copy."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = [(0, " ".join(base))]
    for i in range(1, 121):
        changed = rng.sample(range(60), 3)
        texts.append((i, " ".join(f"own{i}x{at}" if at in changed else w for at, w in enumerate(base))))
    sizes, plain = [], line_dedup.stored

    def counted(df, name):
        out = plain(df, name)
        if name == "line-pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    got = {r.doc_id: r.removed_lines for r in line_dedup.report(spark.createDataFrame(texts, "doc_id long, text string").repartition(2)).collect()}
    assert got == {i: "0" if i else "" for i, _ in texts}
    # First the pairs with the earliest line, then those of all others; each is counted before and after the wide parity.
    assert len(sizes) == 4 and sizes[2] < 1500


def test_words_of_a_line_are_ordered_without_copying_the_rarity_table(spark):
    """The table is read in its place; as a column of a row it would be copied with each of them."""
    docs = spark.createDataFrame([(1, "a b c\n\nc  a\tb a"), (2, None)], "doc_id long, text string")
    with line_dedup.workspace(spark):
        levels = line_dedup.stored(line_dedup.rarity(docs), "rarity").scalar()
        lines = line_dedup.sketched(line_dedup._texts(docs, "doc_id", "text"), levels)
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert "AS levels" not in plan and "scalar-subquery" in plan
        first, second = lines.orderBy("no").collect()
    assert (first.doc, first.no, second.no, first.n) == (1, 0, 2, 3)
    assert (first.s1, first.s2, first.bits, first.p, first.g) == (second.s1, second.s2, second.bits, second.p, second.g)


def test_large_groups_have_several_heads(spark):
    """Lines far from the earliest one of their group, but near to another early one, are settled before the join of all others."""
    sets = spark.createDataFrame([(i, 50, 0 if i % 4 == 0 else (1 << 30) - 1, 0, [7]) for i in range(80)], "id long, n int, bits long, upper long, g array<int>")
    with line_dedup.workspace(spark):
        pairs = {(r.x, r.y) for r in line_dedup._gathered(sets, 80).collect()}
    assert {y for _, y in pairs} == set(range(80)) - {0, 1}
    assert len(pairs) <= 80 * (line_dedup.HEADS + 1)


def test_kept_tables_stay_until_the_outer_workspace_ends(spark):
    with line_dedup.workspace(spark):
        with line_dedup.workspace(spark) as keep:
            inner = line_dedup.stored(spark.range(3), "inner")
            kept = keep(inner, "kept")
            place = inner.inputFiles()[0]
        assert kept.count() == 3 and not os.path.exists(place.removeprefix("file://"))
        place = kept.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(place)


def test_marked_keeps_every_key(spark):
    keys = spark.range(0, 3000, 3)
    few = line_dedup.marked(keys, "marks")
    kept = {r.id for r in spark.range(100_000).where(few(F.col("id"))).collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1000 + 99_000 // 10


def brute_components(texts, k, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        if i is not None and w:
            sets.setdefault(i, []).append(frozenset(tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))))
    root = {i: i for i, _ in texts if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, texts, k, percent):
    want = brute_components(texts, k, percent)
    got = minhash.near_duplicates(docs, k, percent).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None else (want[r.doc_id], r.doc_id == want[r.doc_id]))
    left = minhash.representatives(docs, k, percent)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").select("doc_id").collect()) == sorted(set(want.values()))
    assert minhash.near_duplicates(empty, k, percent).count() == 0


def test_family_of_borderline_copies(spark):
    """Copies around the threshold of each other, without their original: every link counts."""
    rng = random.Random(11)
    base = " ".join(f"b{i}" for i in range(100))
    rows = [(i, edited(rng, base, 1 + i % 7)) for i in range(150)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 3, 85)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(50)]
    root = {i: i for p in pairs for i in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    joined = {i for a, b in pairs if a != b for i in (a, b)}
    assert got == {i: find(i) for i in joined}


def test_pipeline(spark, docs, tmp_path, texts):
    rng = random.Random(6)
    clean = [(5000 + i, "\n".join(sentence(rng, 40).replace("w", f"c{i}w") for _ in range(3))) for i in range(6)]
    leak = sentence(rng, 80)
    more = spark.createDataFrame([*clean, (6000, leak + " tail"), (6001, clean[0][1])], "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "decontamination", "mixing"]
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()
    ids = {r.doc_id for r in got}
    assert {i for i, _ in clean} <= ids and not ids & {0, 1, 3, 302, 6000, 6001}

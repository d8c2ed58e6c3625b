"""Readers, archives and streams on files as they are found: indented, damaged, restarted; and rows with nulls in keys."""

import hashlib
import io
import json
import random
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from ledgerloom.catalog.files import _stored_zip
from ledgerloom.functions.text import page_periods
from ledgerloom.operators import pages, quality
from ledgerloom.operators.inventory import latest_manifest
from ledgerloom.operators.ranking import running_position
from ledgerloom.sources import landing, readers, xbrl
from ledgerloom.streaming import jobs
from ledgerloom.streaming.store import BucketStore


def put(folder, name, value, indent=2):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value, indent=indent), encoding="utf-8")


def test_indented_arrays_are_read(spark, tmp_path):
    put(tmp_path / "listed", "listed_info.json", [{"Code": "10010", "CompanyName": "A"}, {"Code": "10020", "CompanyName": "B"}])
    put(tmp_path / "listed", "broken.json", "<html>")
    rows = readers.read_listed_info(spark, str(tmp_path / "listed"), whole_file=True)
    assert sorted(r.Code for r in rows.collect()) == ["10010", "10020"]
    bad = readers.unreadable(spark, str(tmp_path / "listed"), readers.LISTED_SCHEMA, whole_file=True).collect()
    assert [r.file_name for r in bad] == ["broken.json"]
    put(tmp_path / "quotes", "q.json", [{"Code": "1", "Date": "2024-01-01", "Close": 2.5}])
    assert readers.read_quotes(spark, str(tmp_path / "quotes"), whole_file=True).first().Close == 2.5
    put(tmp_path / "research", "r.json", {"ticker": "1", "sources": {"site": {"url": "u", "collected": True, "data": {"x": 1}}}})
    assert [r.site for r in readers.read_research(spark, str(tmp_path / "research"), whole_file=True).collect()] == ["site"]


def test_newest_statements_file_by_its_own_name(spark, tmp_path):
    for name, sales in (("statements_20230101.json", "1"), ("statements_20240101.json", "2"), ("statements_raw_20250101.json", "3")):
        put(tmp_path / "s" / "7203", name, [{"DisclosedDate": "2024-01-01", "NetSales": sales}])
    rows = readers.read_statements(spark, str(tmp_path / "s" / "*"), whole_file=True).collect()
    assert [(r.ticker, r.NetSales, r.file) for r in rows] == [("7203", "2", "statements_20240101.json")]


def manifest(doc_ids, fetched):
    return {"ticker": "7203", "fetched_at": fetched, "results": [{"doc_id": d, "status": "ok", "file_path": f"data/7203/{d}.zip"} for d in doc_ids]}


def test_upsert_keeps_rows_after_a_new_checkpoint(spark, tmp_path):
    store = str(tmp_path / "store")
    put(tmp_path / "a", "manifest_1.json", manifest(["A", "C"], "2024-01-01"))
    jobs.manifest_upsert(spark, str(tmp_path / "a"), store, str(tmp_path / "c1"))
    put(tmp_path / "b", "manifest_2.json", manifest(["B", "C"], "2024-02-01"))
    last = jobs.manifest_upsert(spark, str(tmp_path / "b"), store, str(tmp_path / "c2"))
    rows = {r.doc_id: (r.source_file, r.seq) for r in last.collect()}
    assert rows == {"A": ("manifest_1.json", 0), "B": ("manifest_2.json", 0), "C": ("manifest_2.json", 1)}


def test_unreadable_manifests_leave_a_row(spark, tmp_path):
    source, store, checkpoint = str(tmp_path / "m"), str(tmp_path / "store"), str(tmp_path / "c")
    lines = "\n".join([json.dumps(manifest(["A"], "1")), '{"ticker": "72', json.dumps(manifest(["B"], "1"))])
    put(tmp_path / "m", "lines.json", lines)
    put(tmp_path / "m", "indented.json", manifest(["C"], "2"))
    put(tmp_path / "m", "page.json", "<html>\n</html>")
    put(tmp_path / "m", "other.json", {"ticker": "1"}, indent=None)
    put(tmp_path / "m", "empty.json", "")
    rows = jobs.manifest_upsert(spark, source, store, checkpoint)
    assert sorted(r.doc_id for r in rows.collect()) == ["A", "B", "C"]
    errors = lambda: sorted(tuple(r) for r in jobs.read_errors(spark, f"{store}_errors").collect())
    found = errors()
    assert [f for f, _ in found] == ["lines.json", "other.json", "page.json", "page.json"]
    assert found[0][1] == '{"ticker": "72'
    jobs.manifest_upsert(spark, source, store, str(tmp_path / "c2"))
    assert errors() == found


def stored_rows(spark, items):
    rows = [(t, d, f, "m", "ok", None, 0) for t, d, f in items]
    return spark.createDataFrame(rows, jobs.STORED_MANIFESTS)


def test_store_rewrites_touched_buckets_only(spark, tmp_path):
    table = BucketStore(spark, str(tmp_path / "s"), jobs.STORED_MANIFESTS, ["ticker"], buckets=16)
    assert table.read().count() == 0
    tickers = [str(i) for i in range(40)]
    assert table.upsert(stored_rows(spark, [(t, "A", "1") for t in tickers]), latest_manifest, "stream", 0) == 0
    first = table.entry()["folders"]
    assert table.upsert(stored_rows(spark, [("7", "A", "2"), ("7", "B", "1")]), latest_manifest, "stream", 1) == 1
    second = table.entry()["folders"]
    assert sum(first[b] != second[b] for b in first) == 1
    newest = {(r.ticker, r.doc_id): r.fetched_at for r in table.read().collect()}
    assert newest == {**{(t, "A"): "1" for t in tickers}, ("7", "A"): "2", ("7", "B"): "1"}
    # The version before is whole until another one follows; then what nobody names is deleted.
    assert table.read(0).count() == 40
    table.upsert(stored_rows(spark, [("7", "C", "1")]), latest_manifest, "stream", 2)
    assert table.versions() == [1, 2] and table.read(1).count() == 41
    left = {p.parent.relative_to(tmp_path / "s").as_posix() for p in (tmp_path / "s" / "data").rglob("*.parquet")}
    assert left == {f for v in (1, 2) for f in table.entry(v)["folders"].values()}


def test_store_knows_a_repeated_batch_and_a_second_writer(spark, tmp_path):
    table = BucketStore(spark, str(tmp_path / "s"), jobs.STORED_MANIFESTS, ["ticker"], buckets=4)
    table.upsert(stored_rows(spark, [("1", "A", "1")]), latest_manifest, "stream", 5)
    assert table.upsert(stored_rows(spark, [("1", "A", "9")]), latest_manifest, "stream", 5) is None
    assert table.upsert(stored_rows(spark, []), latest_manifest, "stream", 6) is None
    assert table.upsert(stored_rows(spark, [("1", "B", "1")]), latest_manifest, "other", 0) == 1
    entry = table.entry()
    with pytest.raises(RuntimeError):
        table._commit(entry)
    assert table.versions() == [0, 1] and table.read().count() == 2


def filing(doc, date="x"):
    fields = {"edinetCode": "E1", "docDescription": "有価証券報告書", "xbrlFlag": "1", "formCode": "030000"}
    return {"docID": doc, **fields, "filerName": date}


def listing(date, docs):
    return json.dumps({"date": date, "results": [filing(d, date) for d in docs]}, ensure_ascii=False)


def test_filing_stream_after_a_restart_with_a_damaged_list(spark, tmp_path):
    source, target = tmp_path / "lists", str(tmp_path / "filings")
    put(source, "a.json", listing("2024-03-30", ["S1000001", "S1000002"]) + "\n" + listing("2024-04-02", ["S1000002", "S1000003"]))
    put(source, "b.json", '{"date": "2024-04-0')
    put(source, "c.json", {"date": "2024-05-01", "results": [filing("S1000004")]})
    put(source, "d.json", listing(None, ["S1000005"]))
    first = jobs.filing_stream(spark, str(source), target, str(tmp_path / "c1"))
    assert sorted((r.docID, str(r.list_date)) for r in first.collect()) == [
        ("S1000001", "2024-03-30"), ("S1000002", "2024-03-30"), ("S1000003", "2024-04-02"), ("S1000004", "2024-05-01"), ("S1000005", "None")]
    # The list of a day comes again, with one more filing, under the old checkpoint and under a new one.
    put(source, "e.json", listing("2024-04-03", ["S1000001", "S1000006"]) + "\n" + listing(None, ["S1000005"]))
    for checkpoint in ("c1", "c1", "c2"):
        rows = jobs.filing_stream(spark, str(source), target, str(tmp_path / checkpoint), files_per_batch=2)
    assert sorted(r.docID for r in rows.collect()) == [f"S100000{i}" for i in range(1, 7)]
    assert [tuple(r) for r in jobs.read_errors(spark, f"{target}_errors").collect()] == [("b.json", '{"date": "2024-04-0')]


def test_filings_far_apart_are_compared_without_a_horizon(spark, tmp_path):
    source, target = tmp_path / "lists", str(tmp_path / "filings")
    put(source, "a.json", listing("2020-01-01", ["S1000001"]))
    jobs.filing_stream(spark, str(source), target, str(tmp_path / "c"))
    put(source, "b.json", listing("2024-01-01", ["S1000001"]))
    assert jobs.filing_stream(spark, str(source), target, str(tmp_path / "c"), horizon_days=None).count() == 1


def test_landing_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        landing.shared_folder(Session(), "x")


def test_numbering_keeps_null_keys_and_buckets(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 5), (None, None)], "k string, v int")
    got = running_position(rows, ["k"], [F.col("v") / 10], [F.col("v")]).collect()
    assert len(got) == 4 and sorted(r.position for r in got) == [1, 1, 2, 2]


def test_long_heads_long_statements_and_long_error_pages(spark):
    text = "x" * 3000 + " 2024年3月31日"
    assert spark.createDataFrame([(text,)], "t string").select(F.size(page_periods(F.col("t")))).first()[0] == 1
    body = [("d", i, "【連結貸借対照表】" if i == 1 else "単位：千円") for i in range(1, 13)]
    spans = pages.statement_spans(pages.statement_headers(spark.createDataFrame(body, "document_id string, page_no int, text string")))
    assert spans.count() == 12
    files = [("a.zip", b"PK\x03\x04", 4), ("b.zip", b"<html>" + b" " * 2048, 2054), ("c.pdf", b"\n%PDF-1.7", 9), ("d.pdf", b"", 0), ("e.txt", b"", 0)]
    frame = spark.createDataFrame([(p, bytearray(c), n) for p, c, n in files], "path string, content binary, length long")
    assert sorted(r.path for r in readers.corrupt_files(frame).collect()) == ["b.zip", "d.pdf"]


def test_damaged_archives_are_rows(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("XBRL/PublicDoc/main.xbrl", "<xbrl>" + "y" * 5000 + "</xbrl>")
    data = bytearray(buffer.getvalue())
    encrypted = bytearray(data)
    encrypted[6] |= 1
    encrypted[encrypted.rindex(b"PK\x01\x02") + 8] |= 1
    broken = bytearray(data)
    broken[60:70] = b"\xff" * 10
    frame = spark.createDataFrame([("a/E.zip", encrypted), ("a/B.zip", broken)], "path string, content binary")
    assert {r.document_id for r in xbrl.xbrl_facts(frame).where("error IS NOT NULL").collect()} == {"E", "B"}
    assert {r.document_id for r in xbrl.narrative_errors(frame).collect()} == {"E", "B"}


def test_company_without_gates_has_not_passed(spark):
    gates = spark.createDataFrame([("1", "g", "error", True)], "ticker string, gate_id string, severity string, pass boolean")
    companies = spark.createDataFrame([("1",), ("2",)], "ticker string")
    assert {r.ticker: (r.gates, r.overall_pass) for r in quality.gate_rollup(gates, companies=companies).collect()} == {"1": (1, True), "2": (0, False)}


def test_rows_of_many_archives_share_a_batch():
    import pyarrow as pa

    paths, contents = [], []
    for i in range(50):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("XBRL/PublicDoc/main.xbrl", '<xbrl><context id="c"><period><instant>2024-03-31</instant></period></context><f contextRef="c">7</f></xbrl>')
        paths.append(f"a/{i}.zip")
        contents.append(b"<html>" if i == 7 else buffer.getvalue())
    batch = pa.RecordBatch.from_pydict({"path": paths, "content": contents})
    out = list(xbrl._reader(False)(iter([batch])))
    assert len(out) == 1 and out[0].num_rows == 50
    assert [r["document_id"] for r in out[0].to_pylist() if r["error"]] == ["7"]
    assert list(xbrl._reader(True)(iter([batch.slice(0, 3)]))) == []


def test_batches_that_wait_are_merged_together(spark, tmp_path):
    source, store, checkpoint = str(tmp_path / "m"), str(tmp_path / "store"), str(tmp_path / "c")
    for i in range(4):
        put(tmp_path / "m", f"m{i}.json", json.dumps(manifest(["A", f"D{i}"], str(i))))
    rows = jobs.manifest_upsert(spark, source, store, checkpoint, files_per_batch=1)
    assert {r.doc_id: r.source_file for r in rows.collect()} == {"A": "m3.json", **{f"D{i}": f"m{i}.json" for i in range(4)}}
    table = BucketStore(spark, store, jobs.STORED_MANIFESTS, ["ticker"])
    assert table.versions() == [0] and list(table.entry()["batches"].values()) == [3]
    assert not any((tmp_path / "store_waiting").glob("*/rows"))
    put(tmp_path / "m", "m4.json", json.dumps(manifest(["D0"], "9")))
    rows = jobs.manifest_upsert(spark, source, store, checkpoint, files_per_batch=1)
    assert {r.doc_id: r.source_file for r in rows.collect()}["D0"] == "m4.json" and table.versions() == [0, 1]


def test_rows_that_an_ended_run_left_waiting_are_merged(spark, tmp_path, monkeypatch):
    source, store, checkpoint = str(tmp_path / "m"), str(tmp_path / "store"), str(tmp_path / "c")
    put(tmp_path / "m", "m0.json", json.dumps(manifest(["A"], "1")) + '\n{"ticker')
    with monkeypatch.context() as m:
        m.setattr(jobs, "_batches_in", lambda *_: [])
        assert jobs.manifest_upsert(spark, source, store, checkpoint).count() == 0
    assert [r.doc_id for r in jobs.manifest_upsert(spark, source, store, checkpoint).collect()] == ["A"]
    assert [r.payload for r in jobs.read_errors(spark, f"{store}_errors").collect()] == ['{"ticker']


def test_a_waiting_batch_is_one_job(spark, tmp_path, monkeypatch):
    source, store = str(tmp_path / "m"), str(tmp_path / "store")
    for i in range(4):
        put(tmp_path / "m", f"m{i}.json", json.dumps(manifest([f"D{i}", "A"], str(i))) + '\n{"ticker": "' + str(i))
    put(tmp_path / "m", "indented.json", manifest(["C"], "2"))
    put(tmp_path / "m", "page.json", "<html>\n</html>")
    calls = []
    frame = type(spark.range(1))
    for kind, name in ((frame, "collect"), (frame, "persist"), (DataFrameWriter, "parquet")):
        def counted(self, *args, _run=getattr(kind, name), _name=name, **kwargs):
            calls.append((_name, *args))
            return _run(self, *args, **kwargs)
        monkeypatch.setattr(kind, name, counted)
    merged = jobs.manifest_upsert(spark, source, store, str(tmp_path / "c"), files_per_batch=1)
    waiting = [c for c in calls if "_waiting/" in str(c)]
    # One write per file, one more for the two files without a payload in their lines, and nothing else until they are merged.
    assert len(waiting) == 8 and [c[0] for c in calls].count("collect") == 1 and ("persist",) not in calls
    monkeypatch.undo()
    assert sorted((r.doc_id, r.source_file, r.seq) for r in merged.collect()) == [
        ("A", "m3.json", 1), ("C", "indented.json", 0), *((f"D{i}", f"m{i}.json", 0) for i in range(4))]
    errors = sorted((r.file_name, r.payload) for r in jobs.read_errors(spark, f"{store}_errors").collect())
    assert errors == [*((f"m{i}.json", f'{{"ticker": "{i}') for i in range(4)), ("page.json", "</html>"), ("page.json", "<html>")]


def test_rows_waiting_in_the_earlier_form_are_merged(spark, tmp_path):
    source, store, checkpoint = str(tmp_path / "m"), str(tmp_path / "store"), str(tmp_path / "c")
    put(tmp_path / "m", "m0.json", json.dumps(manifest(["A"], "1")))
    waiting = f"{store}_waiting/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    stored_rows(spark, [("7", "B", "1")]).write.parquet(f"{waiting}/rows/batch=0")
    spark.createDataFrame([("x.json", "<html>")], jobs.ERRORS).write.parquet(f"{waiting}/errors/batch=0")
    assert sorted(r.doc_id for r in jobs.manifest_upsert(spark, source, store, checkpoint).collect()) == ["A", "B"]
    assert [r.payload for r in jobs.read_errors(spark, f"{store}_errors").collect()] == ["<html>"]


def archive(members, **kwargs):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", **kwargs) as out:
        for name, data in members:
            out.writestr(name, data)
    return buffer.getvalue()


INSTANCE = '<xbrl><context id="c"><period><instant>2024-03-31</instant></period></context><f contextRef="c">' + "7" * 40 + "</f></xbrl>"
MEMBERS = [("XBRL/AuditDoc/audit.xbrl", "<xbrl/>"), ("XBRL/PublicDoc/main.xbrl", INSTANCE), ("読む.txt", "x")]


def read_by(content, narrative):
    try:
        return ElementTree.tostring(xbrl._instance(content, narrative))
    except Exception as exc:
        return type(exc).__name__


def test_ordinary_archives_are_read_without_the_library(monkeypatch):
    stored, packed = archive(MEMBERS), archive(MEMBERS, compression=zipfile.ZIP_DEFLATED)
    made = _stored_zip([(n.encode(), d.encode()) for n, d in MEMBERS[:2]])
    with zipfile.ZipFile(io.BytesIO(made)) as opened:
        assert opened.testzip() is None and {n: opened.read(n).decode() for n in opened.namelist()} == dict(MEMBERS[:2])
    monkeypatch.setattr(zipfile, "ZipFile", None)
    for content in (stored, packed, made):
        assert read_by(content, False) == read_by(content, True) == INSTANCE.encode()
    assert read_by(stored.replace(b".xbrl", b".text"), False) == "ValueError"


def test_damaged_archives_are_read_as_by_the_library(monkeypatch):
    rng = random.Random(5)
    whole = [archive(MEMBERS), archive(MEMBERS, compression=zipfile.ZIP_DEFLATED), archive(MEMBERS[:1]), archive([])]
    whole += [archive(MEMBERS + [MEMBERS[1]]), archive(MEMBERS, compression=zipfile.ZIP_BZIP2), b"before" + whole[0], whole[0] + b"behind"]
    damaged = []
    for content in whole * 150:
        data = bytearray(content)
        for _ in range(rng.choice([1, 1, 2, 5])):
            # Mostly in the directory, where the fields of the format are dense.
            at = rng.randrange(max(0, len(data) - 240), len(data)) if rng.random() < 0.7 else rng.randrange(len(data))
            data[at] = rng.choice([0, 1, 255, data[at] ^ 1 << rng.randrange(8)])
        damaged.append(bytes(data[: rng.randrange(len(data))] if rng.random() < 0.1 else data))
    contents = whole + damaged
    got = [read_by(c, n) for c in contents for n in (False, True)]
    plain = sum(xbrl._plain_members(c) is not None for c in contents)
    monkeypatch.setattr(xbrl, "_plain_members", lambda _: None)
    assert got == [read_by(c, n) for c in contents for n in (False, True)]
    assert plain > 100 and len({g for g in got if isinstance(g, str)}) > 2

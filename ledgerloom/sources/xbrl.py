"""Filing archives: facts, contexts and narrative blocks of the XBRL member of each zip."""

from __future__ import annotations

import functools
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.numbers import strip
from ledgerloom.functions.text import strip_html
from ledgerloom.rules.lexicons import NARRATIVE_ELEMENTS

FACT_ARROW = pa.schema(
    [("document_id", pa.string()), ("seq", pa.int64()), ("concept", pa.string()), ("context_id", pa.string()),
     ("text", pa.string()), ("sign", pa.string()), ("instant", pa.string()), ("start_date", pa.string()),
     ("end_date", pa.string()), ("error", pa.string())]
)
FACT_SCHEMA = (
    "document_id string, seq bigint, concept string, context_id string, text string, sign string, instant string, "
    "start_date string, end_date string, error string"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)


@functools.lru_cache(4096)
def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


# Fixed values of the zip format: the end record, an entry of the directory, the head of a member.
_END, _ENTRY, _HEAD = struct.Struct("<4s4H2LH"), struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
_UTF8, _ORDINARY_FLAGS, _NEWEST = 0x800, 0x80E, 63


def _plain_extra(extra: bytes) -> bool:
    """Whether the extra fields are whole and none of them says something else about sizes or the name."""
    while len(extra) >= 4:
        kind, size = struct.unpack_from("<2H", extra)
        if kind in (0x0001, 0x7075) or size + 4 > len(extra):
            return False
        extra = extra[size + 4 :]
    return True


def _plain_members(content: bytes) -> dict[str, tuple] | None:
    """Name to raw name, method, checksum, sizes, place and end of the members, if the archive is an ordinary one: no comment on the whole,
    large-file records, encryption or anything before or behind its parts; else nothing."""
    if len(content) < _END.size:
        return None
    directory_end = len(content) - _END.size
    sign, disk, first, here, total, size, at, comment = _END.unpack_from(content, directory_end)
    if sign != b"PK\5\6" or disk or first or here != total or comment or at + size != directory_end or content[-42:-38] == b"PK\6\7":
        return None
    out, places, directory = {}, [], at
    while at < directory_end:
        if at + _ENTRY.size > directory_end:
            return None
        (sign, _, needed, flags, method, _, _, crc, packed, plain, named, extra, noted, _, _, _, place) = _ENTRY.unpack_from(content, at)
        at += _ENTRY.size
        name = content[at : at + named]
        odd = sign != b"PK\1\2" or needed & 255 > _NEWEST or flags & ~_ORDINARY_FLAGS or b"\0" in name or 0xFFFFFFFF in (packed, plain, place)
        if odd or extra and not _plain_extra(content[at + named : at + named + extra]):
            return None
        at += named + extra + noted
        try:
            out[name.decode("utf-8" if flags & _UTF8 else "cp437")] = (name, method, crc, packed, plain, place)
        except UnicodeDecodeError:
            return None
        places.append(place)
    if at != directory_end or len(out) != total or len(places) != total or places != sorted({*places}) or max(places, default=0) >= directory:
        return None
    return {n: (*member, end) for (n, member), end in zip(out.items(), [*places[1:], directory])}


def _plain_member(content: bytes, member: tuple) -> bytes | None:
    """The data of a member that is stored or deflated and as its head, sizes and checksum say; else nothing."""
    name, method, crc, packed, plain, place, end = member
    if place + _HEAD.size > end:
        return None
    sign, *_, named, extra = _HEAD.unpack_from(content, place)
    start = place + _HEAD.size + named + extra
    if sign != b"PK\3\4" or content[place + _HEAD.size : place + _HEAD.size + named] != name or start + packed > end:
        return None
    data = content[start : start + packed]
    if method == zipfile.ZIP_DEFLATED:
        inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        try:
            data = inflate.decompress(data, plain + 1)
        except zlib.error:
            return None
        if not inflate.eof or inflate.unused_data:
            return None
    elif method != zipfile.ZIP_STORED:
        return None
    return data if len(data) == plain and zlib.crc32(data) == crc else None


def _chosen(names: list[str], narrative: bool) -> str:
    names = [n for n in names if n.lower().endswith(".xbrl")]
    if narrative:
        names = [n for n in names if "audit" not in n.lower()][:1]
    if not names:
        raise ValueError("no instance member")
    return min(names, key=lambda n: ("publicdoc" not in n.lower(), len(n), n.lower()))


def _instance(content: bytes, narrative: bool) -> ElementTree.Element:
    """Root of the instance member: public documents first, then the shortest name, then by name.

    For narrative blocks it is the first member that is no audit report. The library's reader costs more than the rest of a small archive,
    so ordinary archives are read without it; it reads whatever is out of the ordinary, and says what is wrong with it.
    """
    members = _plain_members(content)
    if members is not None:
        chosen = _chosen([*members], narrative)
        data = _plain_member(content, members[chosen])
        if data is not None:
            return ElementTree.fromstring(data)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        return ElementTree.fromstring(archive.read(_chosen(archive.namelist(), narrative)))


def _dates(elements: list[ElementTree.Element]) -> dict[str, dict[str, str]]:
    out = {}
    for context in elements:
        if not context.tag.endswith("context") or _local(context.tag) != "context" or context.get("id") is None:
            continue
        period = next((e for e in context if _local(e.tag) == "period"), None)
        if period is not None:
            out[context.get("id")] = {_local(e.tag): e.text.strip() for e in period if e.text and e.text.strip()}
    return out


def _rows(document_id: str, root: ElementTree.Element) -> Iterator[tuple]:
    """Facts with the dates of their context; an element without a known context gives no row."""
    elements = list(root.iter())
    dates = _dates(elements)
    for seq, element in enumerate(elements):
        context = element.get("contextRef")
        if context in dates:
            d = dates[context]
            yield (document_id, seq, _local(element.tag), context, element.text, element.get("sign"),
                   d.get("instant"), d.get("startDate"), d.get("endDate"), None)


def _blocks(document_id: str, root: ElementTree.Element) -> Iterator[tuple]:
    for seq, element in enumerate(root.iter()):
        if _local(element.tag) in NARRATIVE_ELEMENTS:
            yield (document_id, seq, _local(element.tag), None, element.text, None, None, None, None, None)


# Rows and characters of text after which a batch of rows is handed over.
BATCH_ROWS, BATCH_CHARS = 10_000, 8 << 20


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), FACT_ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=FACT_ARROW)


def _reader(narrative: bool):
    """Rows of archives, in batches that hold many small archives."""
    text = FACT_ARROW.get_field_index("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                document_id = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    root = _instance(content, narrative)
                    rows = list((_blocks if narrative else _rows)(document_id, root))
                except (
                    zipfile.BadZipFile, ElementTree.ParseError, ValueError, RuntimeError, NotImplementedError, zlib.error, EOFError, KeyError,
                ) as exc:  # damaged, encrypted or oddly compressed archives
                    rows = [(document_id, *([None] * 8), type(exc).__name__)]
                held += rows
                chars += sum(len(r[text] or "") for r in rows)
                if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield _batch(held)
                    held, chars = [], 0
        if held:
            yield _batch(held)

    return read


def xbrl_facts(archives: DataFrame) -> DataFrame:
    """Facts of all archives with context dates; an unreadable archive gives one row with its error."""
    return archives.select("path", "content").mapInArrow(_reader(False), FACT_SCHEMA).select(
        "*", F.coalesce("instant", "end_date").try_cast("date").alias("period_end"),
        F.when(F.col("instant").isNotNull(), "instant").when(F.coalesce("start_date", "end_date").isNotNull(), "duration")
        .otherwise("unknown").alias("period_type"),
    )


def narrative_errors(archives: DataFrame) -> DataFrame:
    """Archives whose narrative cannot be read, with the kind of error."""
    rows = archives.select("path", "content").mapInArrow(_reader(True), FACT_SCHEMA)
    return rows.filter(F.col("error").isNotNull()).select("document_id", "error")


def narrative_blocks(archives: DataFrame) -> DataFrame:
    """Narrative elements with their text freed of markup; empty texts drop out, unreadable archives are in `narrative_errors`."""
    rows = archives.select("path", "content").mapInArrow(_reader(True), FACT_SCHEMA).filter(F.col("error").isNull())
    cleaned = rows.select("document_id", "seq", F.col("concept").alias("element"), strip_html(F.coalesce("text", F.lit(""))).alias("text"))
    return cleaned.filter(strip(F.col("text")) != "")

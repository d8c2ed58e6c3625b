"""Shared parts of the text operators: word patterns, table access and stored intermediate tables."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of anything but space and \x09-\x0D; an index word is a run of ASCII letters,
# digits and everything beyond ASCII, taken after A-Z are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
INDEX_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, even where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; a purely ASCII text takes the fast built-in way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where that is unset, below the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_IN_USE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("places in use", default=None)


def written(df: DataFrame, name: str) -> str:
    """The folder, below the shared one, to which the rows of ``df`` are written."""
    place = shared_folder(df.sparkSession, name)
    if (places := _IN_USE.get()) is not None:
        places.append(place)
    df.write.parquet(place)
    return place


def noted(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, for tables of few or narrow rows: nothing is done about shuffle files of earlier steps."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read again: lineage ends here, lost executors cost nothing."""
    # Shuffle files of finished steps go when the driver forgets their plans; a long operator would else keep all of them. The
    # listeners may still hold the last plan just after its end, so the driver is asked before a step too.
    df.sparkSession._jvm.System.gc()
    place = written(df, name)
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(place)


def discard(spark: SparkSession, place: str) -> None:
    """Delete a folder of the shared store through Spark's own file system layer."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def workspace(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at the end; what the given function stores stays, as a result that is read later. Inside
    another workspace it stays until that one ends."""
    outer, places = _IN_USE.get(), []
    token = _IN_USE.set(places)

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        place = places.pop()
        if outer is not None:
            outer.append(place)
        return out

    try:
        yield keep
    finally:
        _IN_USE.reset(token)
        for place in places:
            discard(spark, place)


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in cuts of about ``size`` bytes that end at white space, so that no word is cut; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end)) + 1
            later = [i for i in (data.find(b" ", end), data.find(b"\n", end)) if i >= 0]
            end = cut if cut > at else min(later, default=len(data) - 1) + 1
        yield data[at:end]
        at = end

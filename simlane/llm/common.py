"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simlane.session import shared_folder


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by their exact spelling, also beside extra columns that differ only in case."""
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*names)
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[n]}").alias(n) for n in names])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local master without one gets a temporary folder (tests)."""
    return shared_folder(spark)


def staged(df: DataFrame) -> DataFrame:
    """df computed once into the shared folder; later uses read it, also after executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release() -> None:
    """Gives back to the system what this process has freed: workers outlive their tasks, and the next stage needs the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps its own counsel


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a task's function from batches to batches, with release() at its end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def held_out(doc_id: Column) -> Column:
    """True for rows that labels are never learned from: crc32 of the id as text, modulo 3, is 1. Null ids: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts, ':' between them; null parts count as 'null'."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """A text in slices of about so many bytes that end at ASCII white space, so that its words stay whole."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\r\v\f":
            end += 1
        yield data[at:end]
        at = end

"""Keyed stores as a landing table, and a paged library as a data source with offsets.

A store's sets and values land in a table (key, day, value); reading a day's set or getting values by key is then a
filter and a join, and a miss is a row that the inner join leaves out."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from simlane.session import checkpointed


def members(landing: DataFrame, kind: str, day: str) -> DataFrame:
    """Ids of the set of a kind and day."""
    return landing.where((F.col("key") == f"fresh_{kind}") & (F.col("day") == day)).select(F.col("value").alias("id")).distinct()


def values(landing: DataFrame, ids: DataFrame, prefix: str = "item_") -> DataFrame:
    """(id, value) of ids that have one."""
    return ids.withColumn("key", F.concat(F.lit(prefix), "id")).join(landing.select("key", "value"), "key").select("id", "value")


def backfill(landing: DataFrame, kind: str, days: list[str], prefix: str = "item_") -> DataFrame:
    """(day, id, value) of several days' sets."""
    ids = landing.where((F.col("key") == f"fresh_{kind}") & F.col("day").isin(days)).select("day", F.col("value").alias("id")).distinct()
    return ids.withColumn("key", F.concat(F.lit(prefix), "id")).join(landing.where(F.col("day").isNull()).select("key", "value"), "key").select("day", "id", "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(number, value): the lines of a folder's .jsonl files, numbered from 0 in the order of file names and lines. Files are
    split and read by tasks; a split's lines are counted there, and the driver sums up one count a split. Names are those of the file system."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"))
    lines = checkpointed(lines)  # counted and numbered as it was read once
    counts = sorted((r["file"], r["begin"], r["n"], r["first"]) for r in lines.groupBy("file", "begin").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect())
    starts, total = [], 0
    for file, begin, n, first in counts:
        starts.append((file, begin, total - first))
        total += n
    table = spark.createDataFrame(starts, "file string, begin long, shift long")  # a row a split
    return lines.join(F.broadcast(table), ["file", "begin"]).select((F.col("at") + F.col("shift")).alias("number"), "value")


class _Page(InputPartition):
    """Records first .. first + n - 1, the first of which begins at a byte of a file."""

    def __init__(self, file: str, byte: int, first: int, n: int):
        self.file, self.byte, self.first, self.n = file, byte, first, n


class PagedLibrary(DataSource):
    """Records numbered from 0 in files of one JSON record a line, read by page. Options: path (a URI of a folder of
    .jsonl files that all workers reach) and page (records of a read). Files are gone through once for where pages begin;
    a page is read from there on. As a stream it goes on from the last offset, a file and a byte, which Spark keeps in
    the checkpoint, so a read costs what is new."""

    @classmethod
    def name(cls) -> str:
        return "paged_library"

    def schema(self) -> str:
        return "number long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _PagedStream(self.options)


def _opened(path: str):
    """The file system that a path names, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """The folder's .jsonl files by name, as paths in its file system."""
    from pyarrow import fs

    store, base = _opened(path)
    return sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".jsonl"))


def _lines(path: str, file: str, byte: int) -> Iterator[tuple[int, str]]:
    """(the byte behind it, line) of a file's lines from a byte on."""
    store, _ = _opened(path)
    with store.open_input_file(file) as h:
        h.seek(byte)
        rest = b""
        while True:
            some = h.read(1 << 20)
            lines = (rest + some).split(b"\n")
            rest = lines.pop() if some else b""
            for x in lines if some or lines[-1:] != [b""] else lines[:-1]:
                byte += len(x) + 1
                yield byte, x.decode("utf-8").rstrip("\r")
            if not some:
                return


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.page = options["path"], int(options.get("page", "1000"))

    def partitions(self):
        pages, n = [], 0
        for f in _files(self.path):
            begin = 0
            for at, (end, _) in enumerate(_lines(self.path, f, 0)):
                if at % self.page == 0:
                    pages.append(_Page(f, begin, n, 0))
                pages[-1].n += 1
                n, begin = n + 1, end
        return pages

    def read(self, partition):
        for i, (_, x) in enumerate(_lines(self.path, partition.file, partition.byte)):
            if i >= partition.n:
                break
            yield partition.first + i, x


class _PagedStream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.path, self.page = options["path"], int(options.get("page", "1000"))

    def initialOffset(self):
        return {"next": 0, "file": "", "byte": 0}

    def _from(self, start: dict, most: int) -> Iterator[tuple[dict, tuple[int, str]]]:
        """Records behind an offset, each with the offset behind it; files that come later by name are gone on to."""
        n = start["next"]
        for f in _files(self.path):
            if f < start["file"]:
                continue
            for byte, x in _lines(self.path, f, start["byte"] if f == start["file"] else 0):
                if n >= start["next"] + most:
                    return
                n += 1
                yield {"next": n, "file": f, "byte": byte}, (n - 1, x)

    def read(self, start):
        rows, end = [], start
        for end, row in self._from(start, self.page):
            rows.append(row)
        return iter(rows), end

    def readBetweenOffsets(self, start, end):
        return (row for _, row in self._from(start, end["next"] - start["next"]))

"""Text, JSON, CSV, polygon and binary readers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File name endings that count as videos.
VIDEO_EXTENSIONS = ("mp4", "avi", "mov", "wmv", "flv", "mkv", "mpg", "rmvb")


def word_vectors(spark: SparkSession, path: str, dim: int = 200) -> DataFrame:
    """(word, vec) of lines with dim + 1 tokens between single spaces; of a word's lines the last counts."""
    t = spark.read.text(path).select(F.split(F.rtrim("value"), " ").alias("t"), F.monotonically_increasing_id().alias("line")).where(F.size("t") == dim + 1)
    return t.select(F.col("t")[0].alias("word"), F.transform(F.slice("t", 2, dim), lambda x: x.cast("float")).alias("vec"), "line").groupBy("word").agg(F.max_by("vec", "line").alias("vec"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word) trimmed, without blank lines, distinct."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def window_days(today: date, n: int) -> list[str]:
    """The n - 1 days before today as yyyymmdd, latest first."""
    return [(today - timedelta(days=i)).strftime("%Y%m%d") for i in range(1, n)]


def dated_files(spark: SparkSession, folder: str, prefix: str, days: Sequence[str]) -> DataFrame:
    """Lines of the files prefix + day that exist, with their day: trimmed, blank ones dropped. Spark lists the folder
    and opens the named days only."""
    if not days:
        return spark.createDataFrame([], "value string, day string")
    glob = prefix + "{" + ",".join(days) + "}"
    lines = spark.read.option("pathGlobFilter", glob).option("ignoreMissingFiles", True).text(folder)
    day = F.substring(F.col("_metadata.file_name"), len(prefix) + 1, 8)
    return lines.select(F.trim("value").alias("value"), day.alias("day")).where("value <> ''")


def dated_ids(spark: SparkSession, folder: str, prefix: str, days: Sequence[str]) -> DataFrame:
    return dated_files(spark, folder, prefix, days).select(F.col("value").alias("id")).distinct()


def csv_tasks(spark: SparkSession, path: str) -> DataFrame:
    """vid, title, url of lines with five comma-separated fields."""
    t = spark.read.text(path).select(F.split("value", ",").alias("f")).where(F.size("f") == 5)
    return t.select(F.col("f")[0].alias("vid"), F.col("f")[1].alias("title"), F.col("f")[2].alias("url"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word, weight, tag) of a segmentation dictionary: a word a line, with a weight and a tag behind it or not; of a
    word's lines the last counts, blank ones and those whose second field is no number are kept without a weight."""
    t = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"), F.monotonically_increasing_id().alias("line")).where(F.col("f")[0] != "")
    weight = F.get("f", F.lit(1)).try_cast("long")
    tag = F.get("f", F.when(weight.isNull(), 1).otherwise(2))
    return t.groupBy(F.col("f")[0].alias("word")).agg(F.max_by(F.struct(weight.alias("weight"), tag.alias("tag")), "line").alias("x")).select("word", "x.weight", "x.tag")


def plain_tasks(lines: DataFrame, title: str = "none") -> DataFrame:
    """vid, title, url of lines (value) with two tokens; 'id none url' has three and is dropped."""
    t = lines.select(F.split(F.trim("value"), r"\s+").alias("f")).where(F.size("f") == 2)
    return t.select(F.col("f")[0].alias("vid"), F.lit(title).alias("title"), F.col("f")[1].alias("url"))


def stream_tasks(lines: Iterable[str], spark: SparkSession, title: str = "none", at_once: int = 10_000) -> Iterator[DataFrame]:
    """plain_tasks() of lines that come one by one, as from sys.stdin: a table for each at_once of them."""
    held: list[tuple[str]] = []
    for line in lines:
        held.append((line.rstrip("\n"),))
        if len(held) == at_once:
            yield plain_tasks(spark.createDataFrame(held, "value string"), title)
            held = []
    if held:
        yield plain_tasks(spark.createDataFrame(held, "value string"), title)


def id_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The ids of a two-column table, one a row."""
    return df.select(F.explode(F.array(a, b)).alias("id"))


def url_lines(ids: DataFrame, urls: DataFrame) -> DataFrame:
    """'id url', or 'id none url' where the id (id) has no url (id, url)."""
    return ids.join(urls, "id", "left").select(F.when(F.col("url").isNotNull(), F.concat_ws(" ", "id", "url")).otherwise(F.concat(F.col("id").cast("string"), F.lit(" none url"))).alias("value"))


def polygons(spark: SparkSession, root: str) -> DataFrame:
    """level, parent, code, ring of root/province/<code>.txt and root/city/<province>/<code>.txt; the ring is the first
    line, files with an empty one are skipped."""
    from simlane.operators.geo import parse_ring

    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").option("ignoreMissingFiles", True).text(root, wholetext=True)
    path, line = F.col("_metadata.file_path"), F.trim(F.substring_index("value", "\n", 1))
    above = F.element_at(F.split(path, "/"), -2)
    code = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.txt$", "")
    t = t.select(line.alias("line"), above.alias("above"), code.alias("code")).where("line <> ''")
    top = F.col("above") == "province"
    return t.select(F.when(top, "province").otherwise("city").alias("level"), F.when(~top, F.col("above")).alias("parent"), "code", parse_ring(F.col("line")).alias("ring"))


def listed(spark: SparkSession, folder: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """path, name, number (of a numeric stem) and length of all files below a folder, of the given endings in any case,
    in the order of the numbers, then of the names. The contents are not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("ignoreMissingFiles", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    d = d.select("path", name.alias("name"), "length").withColumn("number", F.substring_index("name", ".", 1).try_cast("int"))
    d = d.where(has_extension(F.col("name"), extensions)) if extensions else d
    return d.orderBy(F.col("number").asc_nulls_last(), "name", "path")


def has_extension(name: Column, extensions: Sequence[str] = VIDEO_EXTENSIONS) -> Column:
    return F.lower(F.substring_index(name, ".", -1)).isin(*extensions)


def readable(name: Column) -> Column:
    """Names without 'rmvb': such videos are passed over when training images are cut."""
    return ~F.contains(name, F.lit("rmvb"))


def unzipped(spark: SparkSession, folder: str) -> DataFrame:
    """archive, name and content of each file in the zip archives of a folder."""
    import io
    import zipfile

    import pyarrow as pa

    def run(batches):
        for b in batches:
            for path, raw in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for x in z.infolist():
                        if not x.is_dir():
                            yield pa.RecordBatch.from_pydict({"archive": [path], "name": [x.filename], "content": pa.array([z.read(x)], pa.binary())})

    d = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("ignoreMissingFiles", True).load(folder).select("path", "content")
    return d.mapInArrow(run, "archive string, name string, content binary")

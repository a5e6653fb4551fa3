"""File sources, sinks and streams: a table is written to the shared folder in the form a source reads, and read back."""

from __future__ import annotations

import io
import uuid
import zipfile
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simlane.functions import media
from simlane.operators import dedup as D
from simlane.operators import text
from simlane.plans.registry import query, table
from simlane.plans.rollup_queries import _RINGS, frames
from simlane.plans.sequence_queries import in_order_sql, sequences
from simlane.session import shared_folder
from simlane.sources import files, keyed, sinks
from simlane.streaming import exchange, service


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/simlane-{kind}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file, by the file system that the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def named_file(lines: DataFrame, path: str) -> None:
    """The lines (value) as one file of that name."""
    spark = lines.sparkSession
    jvm, made = spark._jvm, f"{path}-{uuid.uuid4().hex}"
    lines.coalesce(1).write.text(made)
    source = jvm.org.apache.hadoop.fs.Path(made)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(source, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(old)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).rename(at, spark._jvm.org.apache.hadoop.fs.Path(new))


@query("word_vectors", "SELECT 'v' || vec_id AS word, CAST(vec_id AS DOUBLE) AS v0, CAST(label AS DOUBLE) AS v1 FROM embeddings")
def word_vectors(spark, sf_dir):
    """Lines of a word and two numbers; lines of another length are left out."""
    e, path = table(spark, sf_dir, "embeddings"), folder(spark, "vectors")
    good = e.select(F.concat_ws(" ", F.concat(F.lit("v"), "vec_id"), F.col("vec_id").cast("string"), F.col("label").cast("string")).alias("value"))
    good.union(e.select(F.concat(F.lit("short "), "vec_id").alias("value"))).write.text(path)
    return files.word_vectors(spark, path, 2).select("word", *[F.col("vec")[i].cast("double").alias(f"v{i}") for i in range(2)])


@query("stop_words", "SELECT DISTINCT o_orderpriority AS word FROM orders")
def stop_words(spark, sf_dir):
    """Padded words and blank lines."""
    o, path = table(spark, sf_dir, "orders"), folder(spark, "words")
    o.select(F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")).alias("value")).union(o.select(F.lit("  "))).write.text(path)
    return files.word_list(spark, path)


@query("dictionary_words", "SELECT n_name AS word, CAST(n_nationkey AS BIGINT) AS weight, CAST(n_regionkey AS VARCHAR) AS tag FROM nation WHERE n_name NOT LIKE '% %' UNION ALL SELECT 'extra', NULL, 'x'")
def dictionary_words(spark, sf_dir):
    """A segmentation dictionary; the last line of a word counts."""
    n, path = table(spark, sf_dir, "nation").where("n_name NOT LIKE '% %'"), folder(spark, "dictionary")
    lines = n.select(F.concat_ws(" ", "n_name", F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")).alias("value"))
    named_file(n.select(F.concat("n_name", F.lit(" 99 z")).alias("value")).union(lines).union(spark.sql("SELECT 'extra x' UNION ALL SELECT ''")), f"{path}/words.txt")
    return files.dictionary(spark, f"{path}/words.txt")


_TODAY = date(1996, 6, 30)
_IN_WINDOW = "CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-30' - 5 AND DATE '1996-06-30' - 1"


def _daily(spark, sf_dir, prefix, line):
    """Files of six days, one of them outside the window, and one of another kind."""
    path, day = folder(spark, "daily"), F.date_format("o_orderdate", "yyyyMMdd")
    o = table(spark, sf_dir, "orders")
    for d in [*files.window_days(_TODAY, 6), "19960630"]:
        named_file(o.where(day == d).select(line.alias("value")), f"{path}/{prefix}{d}")
    named_file(spark.sql("SELECT 'other' AS value"), f"{path}/other_19960629")
    return path


@query("dated_ids", f"SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE {_IN_WINDOW}")
def dated_ids(spark, sf_dir):
    """The set of ids in the files of the days before a day; days without a file are passed over."""
    path = _daily(spark, sf_dir, "video_list_", F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    return files.dated_ids(spark, path, "video_list_", [*files.window_days(_TODAY, 6), "19000101"])


@query("dated_records", f"SELECT CAST(o_orderkey AS VARCHAR) AS docid, o_orderstatus AS title, o_orderpriority AS dkeys, strftime(o_orderdate, '%Y%m%d') AS day FROM orders WHERE {_IN_WINDOW} AND o_orderkey % 7 <> 0")
def dated_records(spark, sf_dir):
    """Daily files of JSON lines; lines without one of the keys are left out."""
    title = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    line = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("docid"), title.alias("title"), F.col("o_orderpriority").alias("dkeys"), F.lit(1).alias("more")))
    path = _daily(spark, sf_dir, "video_data_", line)
    return text.parse_records(files.dated_files(spark, path, "video_data_", files.window_days(_TODAY, 6))).select("docid", "title", "dkeys", "day")


@query("backfilled", "SELECT day, CAST(page_id AS VARCHAR) AS id, url AS value FROM pages, (VALUES ('1', 2), ('2', 3)) AS d(day, n) WHERE page_id % n = 0 AND page_id % 5 <> 0")
def backfilled(spark, sf_dir):
    """Values of two days' sets of ids, from a landing table; a third day isn't asked for."""
    p = table(spark, sf_dir, "pages")
    sets = [p.where(F.col("page_id") % n == 0).select(F.lit("fresh_doc").alias("key"), F.lit(day).alias("day"), F.col("page_id").cast("string").alias("value")) for day, n in (("1", 2), ("2", 3), ("3", 1))]
    items = p.where("page_id % 5 <> 0").select(F.concat(F.lit("item_"), F.col("page_id").cast("string")).alias("key"), F.lit(None).cast("string").alias("day"), F.col("url").alias("value"))
    path = folder(spark, "landing")
    sets[0].unionByName(sets[1]).unionByName(sets[2]).unionByName(items).write.parquet(path)
    return keyed.backfill(spark.read.parquet(path), "doc", ["1", "2"])


@query("csv_tasks", "SELECT CAST(page_id AS VARCHAR) AS vid, 't' || page_id AS title, 'u' || page_id AS url FROM pages WHERE page_id % 4 <> 0")
def csv_tasks(spark, sf_dir):
    """Lines of five fields; those of another number are left out."""
    p, path = table(spark, sf_dir, "pages"), folder(spark, "csv")
    i = F.col("page_id").cast("string")
    p.select(F.concat_ws(",", i, F.concat(F.lit("t"), i), F.concat(F.lit("u"), i), F.lit(""), F.when(F.col("page_id") % 4 != 0, F.lit("x"))).alias("value")).write.text(path)
    return files.csv_tasks(spark, path)


@query("polygon_files", f"""SELECT * FROM (VALUES {", ".join(f"('{lv}', {'NULL' if pa is None else repr(pa)}, '{code}', {len(line.split(';'))})" for lv, pa, code, line in _RINGS)}) AS t(level, parent, code, points)""")
def polygon_files(spark, sf_dir):
    """A tree of files with a ring each; an empty one is passed over."""
    path = folder(spark, "rings")
    for level, parent, code, line in _RINGS:
        put(spark, f"{path}/{level}/{'' if parent is None else parent + '/'}{code}.txt", f"{line}\n".encode())
    put(spark, f"{path}/city/A/none.txt", b"")
    return files.polygons(spark, path).select("level", "parent", "code", F.size("ring").alias("points"))


@query("listed_files", "SELECT r_regionkey || '.jpg' AS name, CAST(r_regionkey AS INTEGER) AS number, CAST(length(r_name) AS BIGINT) AS length FROM region")
def listed_files(spark, sf_dir):
    """Files of one ending, with their number and size."""
    path = folder(spark, "listing")
    for r in table(spark, sf_dir, "region").select("r_regionkey", "r_name").collect():
        put(spark, f"{path}/{r['r_regionkey']}.jpg", r["r_name"].encode())
        put(spark, f"{path}/{r['r_regionkey']}.txt", b"x")
    return files.listed(spark, path, ["jpg"]).select("name", "number", "length")


@query("unzipped", "SELECT 'in/' || r_regionkey AS name, r_name AS content FROM region")
def unzipped(spark, sf_dir):
    """The files of an archive."""
    path, raw = folder(spark, "zip"), io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for r in table(spark, sf_dir, "region").select("r_regionkey", "r_name").collect():
            z.writestr(f"in/{r['r_regionkey']}", r["r_name"])
    put(spark, f"{path}/a.zip", raw.getvalue())
    return files.unzipped(spark, path).select("name", F.col("content").cast("string").alias("content"))


@query("published_lines", "SELECT CAST(page_id AS VARCHAR) || chr(9) || url AS value FROM pages")
def published_lines(spark, sf_dir):
    """An index folder that is marked as whole, read back."""
    lines = table(spark, sf_dir, "pages").select(F.concat_ws("\t", F.col("page_id").cast("string"), "url").alias("value"))
    return spark.read.text(sinks.publish(lines, folder(spark, "index"), 1700000000))


@query("daily_snapshots", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS day FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0")
def daily_snapshots(spark, sf_dir):
    """Two days are written, then one of them again with fewer rows; the other stays."""
    e, path = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("day")), folder(spark, "days")
    sinks.snapshot(e, path)
    sinks.snapshot(e.where("day = 'b' AND event_id % 3 = 0"), path)
    return spark.read.parquet(path).select("event_id", F.col("day").cast("string").alias("day"))


@query("score_files", "SELECT CAST(event_id AS VARCHAR) AS filename, CAST(event_id % 10 AS VARCHAR) AS score FROM events")
def score_files(spark, sf_dir):
    """Scores as CSV with a header."""
    path = folder(spark, "scores")
    sinks.score_csv(table(spark, sf_dir, "events").select(F.col("event_id").alias("filename"), (F.col("event_id") % 10).alias("score")), path)
    return spark.read.option("header", True).csv(path)


@query("paged_records", "SELECT row_number() OVER (ORDER BY event_id) - 1 AS number, CAST(event_id AS VARCHAR) AS value FROM events")
def paged_records(spark, sf_dir):
    """All records of a library of several files, numbered through."""
    path = folder(spark, "library")
    table(spark, sf_dir, "events").select("event_id").orderBy("event_id").select(F.col("event_id").cast("string").alias("value")).write.text(f"{path}/parts")
    names = spark.read.text(f"{path}/parts").select(F.col("_metadata.file_name").alias("name")).distinct().collect()
    for r in names:
        rename(spark, f"{path}/parts/{r['name']}", f"{path}/parts/{r['name']}.jsonl")
    return keyed.numbered_lines(spark, f"{path}/parts")


_STREAMED = f"{in_order_sql(D.V2, 'vid % 2, vid')} SELECT vid, CASE WHEN len(hit) = 0 THEN 1 ELSE 0 END AS is_unique, hit[1].c AS similar_vid FROM told"


@query("streamed_detection", _STREAMED)
def streamed_detection(spark, sf_dir):
    """Documents of even id come in one micro-batch and those of odd id in the next, which meets the index that the first
    has left; within a batch one after the other."""
    occ, path = sequences(spark, sf_dir).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")), folder(spark, "stream")
    for half in (0, 1):
        occ.where(F.col("vid") % 2 == half).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema("vid long, pos int, hash string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    q = service.detect_stream(stream, f"{path}/index", f"{path}/out", D.V2, f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out").select("vid", "is_unique", "similar_vid")


@query("drained_requests", "SELECT CAST(event_id AS VARCHAR) AS vid, event_type AS title FROM events")
def drained_requests(spark, sf_dir):
    """Requests that are submitted, taken in with a bound on files and drained batch by batch."""
    path = folder(spark, "drain")
    service.submit(table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("vid"), F.col("event_type").alias("title")), f"{path}/in")
    stream = service.intake(spark, f"{path}/in", "vid string, title string", 1)
    q = service.drained(stream, f"{path}/out", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("vid string, title string").json(f"{path}/out").select("vid", "title")


_EXCHANGED = """WITH e AS (SELECT event_id, CAST(event_id AS VARCHAR) AS vid, date_trunc('second', ts) AS t, CASE WHEN event_id % 3 > 0 THEN event_id % 1000 - 450 END AS later FROM events)
SELECT vid, t AS asked_at, CASE WHEN later BETWEEN -360 AND 300 THEN event_id % 2 = 0 END AS has_same_video, CASE WHEN later BETWEEN -360 AND 300 THEN 'v' || event_id END AS same_video,
  CASE WHEN later BETWEEN -360 AND 300 THEN 0 ELSE 1 END AS err_code, CASE WHEN later BETWEEN -360 AND 300 THEN 'done' ELSE 'given up' END AS state FROM e"""


@query("exchanged_results", _EXCHANGED)
def exchanged_results(spark, sf_dir):
    """Each event asks; two thirds have a result from 450 seconds before to 549 behind it. Requests and results are a stream whose state
    gives up requests and results that have waited too long."""
    e, path = table(spark, sf_dir, "events"), folder(spark, "exchange")
    second, later = F.unix_timestamp("ts"), F.col("event_id") % 1000 - 450
    vid = F.col("event_id").cast("string")
    none = [F.lit(None).cast(k).alias(n) for n, k in (("has_same_video", "boolean"), ("same_video", "string"), ("err_code", "int"))]
    asks = e.select(vid.alias("vid"), F.lit("ask").alias("kind"), F.timestamp_seconds(second).alias("at"), *none)
    results = e.where("event_id % 3 > 0").select(vid.alias("vid"), F.lit("result").alias("kind"), F.timestamp_seconds(second + later).alias("at"), (F.col("event_id") % 2 == 0).alias("has_same_video"), F.concat(F.lit("v"), vid).alias("same_video"), F.lit(0).alias("err_code"))
    events = asks.unionByName(results)
    events.unionByName(exchange.end_of(events)).write.parquet(f"{path}/in")
    buckets = max(1, spark.read.parquet(f"{path}/in").count() // 4000)
    stream = exchange.exchanged(spark.readStream.schema(exchange.EVENTS).parquet(f"{path}/in"), buckets=buckets)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:  # a partition of state has a worker of its own in each batch
        spark.conf.set("spark.sql.shuffle.partitions", min(int(kept), spark.sparkContext.defaultParallelism))
        stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    return spark.read.schema(exchange.ANSWERS).parquet(f"{path}/out")


def pictures(spark, sf_dir):
    """A grey picture of one line made of each vector, its bytes three times."""
    byte = F.transform("embedding", lambda x: F.lpad(F.hex(F.pmod(F.floor(x.cast("double") * 1000), F.lit(256))), 2, "0"))
    e = table(spark, sf_dir, "embeddings").where(F.size("embedding") > 0)
    raw = F.unhex(F.array_join(F.flatten(F.transform(byte, lambda h: F.array(h, h, h))), ""))
    return e.select(F.col("vec_id").alias("vid"), F.lit(0).alias("pos"), raw.alias("raw"), F.lit(1).alias("h"), F.size("embedding").alias("w"), F.lit(3).alias("c"))


@query("frame_hashes")
def frame_hashes(spark, sf_dir):
    """Perceptual hashes of pictures."""
    return media.frame_features(pictures(spark, sf_dir)).select("vid", "hash")


@query("frame_histograms", """WITH b AS (SELECT vec_id AS vid, len(embedding) AS n, len(list_filter(embedding, lambda x: ((CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) % 256) + 256) % 256 < 178.5)) AS dark FROM embeddings WHERE len(embedding) > 0)
SELECT vid, n || ',0,0,0,0,0,0,' || n || ',0,' || dark || ',' || (n - dark) AS feature FROM b""")
def frame_histograms(spark, sf_dir):
    """Colour histograms of pictures: grey ones have no hue and no saturation."""
    return media.frame_features(pictures(spark, sf_dir)).select("vid", F.array_join(F.transform("feature", lambda x: x.cast("int").cast("string")), ",").alias("feature"))


@query("dumped_frames", "SELECT n_nationkey || '/7.raw' AS name, n_name AS content FROM nation")
def dumped_frames(spark, sf_dir):
    """Frames written one a file, read back."""
    n, path = table(spark, sf_dir, "nation"), folder(spark, "dump")
    path = path if ":" in path.split("/")[0] else f"file://{path}"
    shaped = n.select(F.col("n_nationkey").cast("string").alias("vid"), F.lit(7).alias("second"), F.col("n_name").cast("binary").alias("raw"), F.lit(1).alias("h"), F.length("n_name").alias("w"), F.lit(1).alias("c"))
    sinks.dump_frames(shaped, path, lambda raw, h, w, c: raw, "raw").write.format("noop").mode("overwrite").save()
    files_ = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files_.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("name"), F.col("content").cast("string").alias("content"))


@query("dumped_scores", "SELECT CAST(user_id AS VARCHAR) AS video, count(*) AS n FROM events GROUP BY 1")
def dumped_scores(spark, sf_dir):
    """Frames of each video as a log folder by video, a folder one file, counted from the files."""
    path = folder(spark, "frames")
    shown = frames(spark, sf_dir).select(F.col("video").cast("string").alias("video"), "event_id")
    return sinks.folder_rows(sinks.dump_folders(shown, path, "video"), path, "video")

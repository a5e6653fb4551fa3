"""The serving shell as Structured Streaming: bounded intake, an index that grows by micro-batch, results that expire."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from simlane.operators import dedup
from simlane.session import checkpointed


def intake(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Requests from files of JSON lines; files_per_batch is the queue's bound."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def submit(requests: DataFrame, folder: str) -> None:
    """Adds requests to the intake; all of them or, if the write fails, none."""
    requests.write.mode("append").json(folder)


def checked(requests: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Requests whose needed fields are all there and not empty, and the others."""
    ok = F.lit(True)
    for c in needed:
        ok = ok & (F.coalesce(F.col(c), F.lit("")) != "")
    return requests.where(ok), requests.where(~ok)


#: Batches after which the index so far is written as one snapshot.
COMPACT = 16


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def index_folders(spark: SparkSession, path: str, before: int) -> list[str]:
    """The folders that hold the index as it was before a batch: the last whole snapshot and the batches since."""
    fs, at = _file_system(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    number = lambda kind: [int(n[len(kind) :]) for n in names if n.startswith(kind)]
    last = max((n for n in number("upto=") if n < before and fs.exists(_file_system(spark, f"{path}/upto={n}/_SUCCESS")[1])), default=-1)
    return [f"{path}/upto={last}"] * (last >= 0) + [f"{path}/batch={n}" for n in sorted(number("batch=")) if last < n < before]


def read_index(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """The occurrences indexed before a batch; an index not yet begun is empty."""
    folders = index_folders(spark, path, before)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: str, batch_id: int, oldest: Column | None = None) -> None:
    """Writes the index up to and with a batch as a snapshot, by hash, without what is older than `oldest`, and removes what the
    snapshot before it holds: a batch that runs again still finds the one it had."""
    before = index_folders(spark, path, batch_id)
    index = read_index(spark, path, schema, batch_id + 1)
    (index if oldest is None else index.where(F.col("ts") >= oldest)).repartitionByRange("hash").sortWithinPartitions("hash", "vid").write.mode("overwrite").parquet(f"{path}/upto={batch_id}")
    if before and "/upto=" in before[0]:
        held = int(before[0].rpartition("=")[2])
        fs, at = _file_system(spark, path)
        for f in fs.listStatus(at):
            kind, _, n = f.getPath().getName().partition("=")
            if n and int(n) < held + (kind == "batch"):
                fs.delete(f.getPath(), True)


def detect_batch(batch: DataFrame, batch_id: int, index_path: str, result_path: str, variant: dedup.Variant, now: Column) -> None:
    """One micro-batch of occurrences (vid, pos, hash, ts) in order of id, each against the index so far and the unique ones
    before it in the batch; unique ones join the index. So results don't depend on where batches are cut. Folders
    carry the batch's number and are replaced, so a batch that runs again after a failure writes the same."""
    spark = batch.sparkSession
    batch = checkpointed(batch)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.schema)
    index = read_index(spark, index_path, kinds, batch_id)
    # of the index only what shares a hash with the batch matters to candidates, and whole sequences of those to lengths
    near = index.join(batch.select("hash").distinct(), "hash", "left_semi").select("vid").distinct()
    met = batch.select("vid").distinct().join(index.select("vid").distinct(), "vid", "left_semi") if variant.refuse_known else near
    index = index.join(near.union(met).distinct(), "vid", "left_semi")
    if variant.max_age_days is not None:
        index = dedup.fresh(index, now, variant.max_age_days)
    verdicts = checkpointed(dedup.detect_in_order(batch, index, variant))
    verdicts.write.mode("overwrite").parquet(f"{result_path}/batch={batch_id}")
    new = batch if variant.refuse_known else batch.join(index.select("vid").distinct(), "vid", "left_anti")
    dedup.indexable(new, verdicts).write.mode("overwrite").parquet(f"{index_path}/batch={batch_id}")
    if (batch_id + 1) % COMPACT == 0:
        oldest = None if variant.max_age_days is None else F.timestamp_seconds(F.unix_timestamp(now) - 86400 * variant.max_age_days)
        compact(spark, index_path, kinds, batch_id, oldest)


def detect_stream(occurrences: DataFrame, index_path: str, result_path: str, variant: dedup.Variant, checkpoint: str, now: Column | None = None) -> DataStreamWriter:
    """Starts with .start(); a batch sees the index of those before it."""
    at = now if now is not None else F.current_timestamp()

    def each(batch: DataFrame, batch_id: int) -> None:
        detect_batch(batch, batch_id, index_path, result_path, variant, at)

    return occurrences.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def responses(verdicts: DataFrame) -> DataFrame:
    """vid with has_same_video, same_video and err_code: 1 where the verdict is an error."""
    bad = F.col("code") != 200
    return verdicts.select("vid", F.when(bad, False).otherwise(F.col("is_unique") == 0).alias("has_same_video"), F.col("similar_vid").alias("same_video"), F.when(bad, 1).otherwise(0).alias("err_code"))


def answered(requests: DataFrame, results: DataFrame, now: Column, ttl: int = 360, wait: int = 300) -> DataFrame:
    """Requests (vid, asked_at) with results (vid, has_same_video, same_video, err_code, done_at) not older than ttl
    seconds; err_code 1 for those that waited in vain."""
    alive = results.where(F.unix_timestamp(now) - F.unix_timestamp("done_at") <= ttl)
    out = requests.join(alive, "vid", "left")
    late = F.col("done_at").isNull() & (F.unix_timestamp(now) - F.unix_timestamp("asked_at") > wait)
    return out.select("vid", "has_same_video", "same_video", F.when(late, 1).otherwise(F.col("err_code")).alias("err_code"), F.when(F.col("done_at").isNotNull() | late, "done").otherwise("waiting").alias("state"))


def drained(results: DataFrame, folder: str, checkpoint: str, every: str = "10 seconds") -> DataStreamWriter:
    """Every so often all new results as files of JSON lines, written where the rows are. Folders carry the batch's number
    and are replaced, so a batch that runs again after a failure writes the same."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{folder}/batch={batch_id}")

    return results.writeStream.foreachBatch(each).trigger(processingTime=every).option("checkpointLocation", checkpoint)


def health(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("status"))

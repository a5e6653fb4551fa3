"""Results as index lines, logs, snapshots and call-back bodies."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simlane.session import checkpointed


def index_lines(recommended: DataFrame) -> DataFrame:
    """(doc, video, score, rank) -> one line a doc: doc, a tab, then video \\x01 score joined by \\x02, in order of rank."""
    item = F.concat(F.col("video").cast("string"), F.lit("\x01"), F.col("score").cast("string"))
    lists = recommended.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))).alias("items"))
    return lists.select(F.concat(F.col("doc").cast("string"), F.lit("\t"), F.array_join(F.transform("items", lambda x: x["item"]), "\x02")).alias("value"))


def human_log(recommended: DataFrame, titles: DataFrame) -> DataFrame:
    """For each doc a line of its own and one line 'video score title' for each hit: (doc, rank, value); titles: (id, title)."""
    recommended = checkpointed(recommended)
    heads = recommended.select("doc").distinct().select("doc", F.lit(0).alias("rank"), F.col("doc").cast("string").alias("value"))
    named = recommended.join(titles.select(F.col("id").alias("video"), "title"), "video", "left")
    return heads.unionByName(named.select("doc", "rank", F.concat(F.lit("-" * 10), F.concat_ws(" ", F.col("video").cast("string"), F.col("score").cast("string"), "title")).alias("value")))


def publish(lines: DataFrame, root: str, bucket: int) -> str:
    """Writes a new folder root/index_<bucket>; it fails if there is one, and _SUCCESS marks it as whole. The bucket is
    passed in once, so that all steps use the same."""
    path = f"{root}/index_{bucket}"
    lines.select("value").write.mode("errorifexists").text(path)
    return path


def snapshot(df: DataFrame, path: str, day: str = "day") -> None:
    """A folder for each day; days in df are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def status_rows(verdicts: DataFrame, now: Column) -> DataFrame:
    """status (unique, repetitive, exception), day, time and the verdict's id and message."""
    status = F.when(F.col("code") != 200, "exception").when(F.col("is_unique") == 1, "unique").otherwise("repetitive")
    return verdicts.select(status.alias("status"), F.date_format(now, "yyyyMMdd").alias("day"), "vid", "msg", F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("time"))


def status_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("status", "day").json(path)


def callback_bodies(rows: DataFrame) -> DataFrame:
    """The form-encoded body of a call-back for each row."""
    return rows.select(F.concat(F.lit("jsonResult="), F.url_encode(F.to_json(F.struct(*rows.columns)))).alias("body"))


def send_each(rows: DataFrame, post: Callable[[str], None], tries: int = 3, wait: float = 1.0) -> None:
    """Calls post with each body on the executors, up to so many times, waiting longer each time; the last failure ends
    the task, which Spark runs again."""

    def run(part):
        import time

        for r in part:
            for n in range(tries):
                try:
                    post(r["body"])
                    break
                except Exception:
                    if n == tries - 1:
                        raise
                    time.sleep(wait * 2**n)

    callback_bodies(rows).foreachPartition(run)


def result_batch(rows: DataFrame) -> DataFrame:
    """One row: a JSON list of all rows of a micro-batch, whose size the trigger bounds."""
    return rows.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*rows.columns)))).alias("value"))


def hash_lines(sequences: DataFrame) -> DataFrame:
    """(vid, pos, hash) -> 'vid \\t hash hash ...'."""
    s = sequences.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("h"))
    return s.select(F.concat(F.col("vid").cast("string"), F.lit("\t"), F.array_join(F.transform("h", lambda x: x["hash"]), " ")).alias("value"))


def grid_lines(cells: DataFrame) -> DataFrame:
    """(id, code) -> 'id \\t code' of cells that have one."""
    return cells.where(F.col("code").isNotNull()).select(F.concat_ws("\t", "id", "code").alias("value"))


def score_csv(scores: DataFrame, path: str) -> None:
    scores.select("filename", "score").write.mode("overwrite").option("header", True).csv(path)


def dump_frames(frames: DataFrame, folder: str, encode: Callable[[bytes, int, int, int], bytes], ending: str = "jpg") -> DataFrame:
    """Writes each frame (vid, second, raw, h, w, c) as <folder>/<vid>/<second>.<ending>, by an encoder that is given,
    and returns the paths. folder is a URI that all executors reach."""

    def run(batches):
        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            paths = []
            for r in pdf.itertuples():
                store.create_dir(f"{base}/{r.vid}", recursive=True)
                paths.append(f"{base}/{r.vid}/{r.second}.{ending}")
                with store.open_output_stream(paths[-1]) as out:
                    out.write(encode(r.raw, r.h, r.w, r.c))
            yield pd.DataFrame({"path": paths})

    return frames.mapInPandas(run, "path string")


def dump_folders(rows: DataFrame, folder: str, by: str) -> DataFrame:
    """Writes rows as one Parquet file for each value of the text column `by`, <folder>/<by>=<value>/part-0.parquet, and returns (by, path).
    folder is a URI that all executors reach, and new. Rows are brought together and into order by value and written as they come, so
    no task holds a value's rows, and neither the driver nor a committer goes through the folders; a task that runs again replaces its files."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        now, out, values, paths = None, None, [], []
        for batch in batches:
            column, data = batch.column(by).to_pylist(), batch.drop_columns([by])
            at = 0
            while at < len(column):
                value, end = column[at], at + 1
                while end < len(column) and column[end] == value:
                    end += 1
                if out is None or value != now:
                    if out is not None:
                        out.close()
                    # as Spark names the folders of a partitioned table
                    name = "__HIVE_DEFAULT_PARTITION__" if value is None else re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{}\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)
                    store.create_dir(f"{base}/{by}={name}", recursive=True)
                    now, path = value, f"{base}/{by}={name}/part-0.parquet"
                    out = pq.ParquetWriter(path, data.schema, filesystem=store)
                    values.append(value)
                    paths.append(path)
                out.write_batch(data.slice(at, end - at))
                at = end
        if out is not None:
            out.close()
        for start in range(0, len(paths), 10_000):
            part = slice(start, start + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(values[part], pa.string()), pa.array(paths[part], pa.string())], names=[by, "path"])

    return checkpointed(rows.repartition(tasks, by).sortWithinPartitions(by).mapInArrow(run, f"{by} string, path string"))


def folder_rows(files: DataFrame, folder: str, by: str) -> DataFrame:
    """(by, n): the rows of each file of dump_folders, told by the files; read where the names are."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            n = [pq.read_metadata(path, filesystem=store).num_rows for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(by), pa.array(n, pa.int64())], names=[by, "n"])

    return files.mapInArrow(run, f"{by} string, n long")

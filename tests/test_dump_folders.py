"""Folders by value are written by the tasks alone, and read as Spark reads a partitioned table."""

from pyspark.sql import functions as F

from simlane.plans import catalog, source_queries
from simlane.sources import sinks

NAMES = ["a", "b/c", "d=e", "50%", "é x", None]


def test_odd_names_and_many_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        names = F.array(*[F.lit(x) for x in NAMES])[(F.col("id") % 6).cast("int")]
        rows = spark.range(600).select(F.when(F.col("id") < 300, "long").otherwise(names).alias("video"), F.col("id").alias("event_id"))
        files = sinks.dump_folders(rows, f"{tmp_path}/out", "video")
        assert files.count() == 7
        got = {r["video"]: r["n"] for r in sinks.folder_rows(files, f"{tmp_path}/out", "video").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == dict.fromkeys(NAMES, 50) | {"long": 300}
    back = spark.read.schema("event_id long, video string").parquet(f"{tmp_path}/out")
    assert sorted(map(str, back.select("video", "event_id").collect())) == sorted(map(str, rows.collect()))


def test_no_job_lists_the_folders(spark, tmp_path, monkeypatch):
    """2000 videos: tasks don't grow with the folders (one a folder when they were listed)."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(50).crossJoin(spark.range(40).withColumnRenamed("id", "i")).withColumn("user_id", F.col("event_id") * 40 + F.col("i")).drop("i").write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(source_queries, "folder", lambda spark, kind: f"{tmp_path}/{kind}")
    spark.sparkContext.setJobGroup("dumped", "dumped_scores")
    try:
        got = catalog.QUERIES["dumped_scores"](spark, f"{tmp_path}/sf").collect()
        told = spark.sparkContext.statusTracker()
        stages = {s for j in told.getJobIdsForGroup("dumped") for s in told.getJobInfo(j).stageIds}
        tasks = sum(info.numTasks for info in map(told.getStageInfo, stages) if info)
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert len(got) == 2000 and all(r["n"] == 1 for r in got)
    assert tasks < 100

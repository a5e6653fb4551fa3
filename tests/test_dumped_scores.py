"""frames by video are one file a folder, however many tasks write."""

from pathlib import Path

from simlane.plans import catalog, source_queries


def test_one_file_a_video(spark, tmp_path, monkeypatch):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(source_queries, "folder", lambda spark, kind: f"{tmp_path}/{kind}")
    got = catalog.QUERIES["dumped_scores"](spark, f"{tmp_path}/sf")
    folders = [f for f in Path(tmp_path, "frames").iterdir() if f.is_dir()]
    assert got.count() == len(folders) > 0
    assert all(len(list(f.glob("part-*"))) == 1 for f in folders)

"""Queries over whole tables leave no row out."""

from simlane.plans import catalog


def test_id_pairs(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert catalog.QUERIES["id_pairs"](spark, small).count() == 2 * lines


def test_nearest_and_candidates(spark, small):
    e = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "label").collect()
    got = catalog.QUERIES["nearest_one"](spark, small).collect()
    assert {r["q"] for r in got} == {r["vec_id"] for r in e} and len({r["c"] % 10 for r in got}) == 10 and all(r["q"] != r["c"] for r in got)
    pairs = sum(a["label"] == b["label"] for a in e for b in e)
    assert catalog.QUERIES["tag_candidates"](spark, small).count() == pairs

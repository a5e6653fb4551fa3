"""Related items block against block: rows of a plain join, ties, odd numbers and sizes too; no pair goes through a join."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_in_order import joined_rows

from simlane.operators import similarity as S
from simlane.sources import sinks

NAN, INF = float("nan"), float("inf")


def plain(docs, videos, metric, threshold, k, same):
    """All pairs of a tag by a join and the score in SQL."""
    q = docs.where("vec is not null").select(F.col("id").alias("q"), F.col("vec").alias("a"), F.explode("tags").alias("tag"))
    c = videos.where("vec is not null").select(F.col("id").alias("c"), F.col("vec").alias("b"), F.explode("tags").alias("tag"))
    met = q.join(c, "tag").where(F.octet_length("tag") > 3).where("true" if same else "q <> c")
    s = met.select("q", "c", (S.cosine if metric == "cosine" else S.euclidean)(F.col("a"), F.col("b")).alias("s")).where(S.keep_score(F.col("s"), threshold, metric)).groupBy("q", "c").agg(F.max("s").alias("s"))
    return S.top_k(s, ["q"], [F.col("s").desc() if metric == "cosine" else F.col("s").asc(), F.col("c").asc()], k)


@pytest.mark.parametrize(("metric", "threshold", "k", "same"), [("cosine", 0.2, 4, False), ("cosine", -1.0, 3, True), ("cosine", 5e-324, 1, False), ("euclid", 1.5, 4, False), ("euclid", INF, 2, True)])
def test_rows_of_a_plain_join(spark, monkeypatch, metric, threshold, k, same):
    monkeypatch.setattr(S, "BLOCK", 7)
    rnd = np.random.default_rng(1)
    vecs = [[float(x) for x in rnd.integers(-2, 3, 3)] for _ in range(36)]  # many ties and copies
    vecs += [None, [1.0, None, 2.0], [NAN, 1.0, 0.0], [INF, 1.0, 1.0], [0.0] * 3, [1.0, 2.0], [0.0, 0.0], []]
    rows = [(i, v, [("hot!", "cold", "no")[j] for j in range(3) if i % (j + 1) == 0] + ["hot!"]) for i, v in enumerate(vecs)]
    x = spark.createDataFrame(rows, "id long, vec array<float>, tags array<string>")
    got = sorted((r["doc"], r["rank"], r["video"], repr(r["score"])) for r in S.recommend(x, x, metric, threshold, k, same).collect())
    assert got == sorted((r["q"], r["rank"], r["c"], repr(r["s"])) for r in plain(x, x, metric, threshold, k, same).collect())


@pytest.fixture
def alike(spark):
    return spark.range(300).select("id", F.array(F.lit(1.0), F.col("id") % 3 / 1.0).alias("vec"), F.array(F.lit("hot!")).alias("tags"))


def test_pairs_of_a_tag_are_not_joined(alike):
    """All pairs of a tag were rows of a join, scored one by one."""
    got = S.recommend(alike, alike, "cosine", 0.2, 40, same=False)
    assert got.count() == 300 * 40
    assert joined_rows(got) <= 700


def test_candidates_are_not_shuffled(spark, alike):
    """pairs were made distinct behind a shuffle. Several tags still give one pair."""
    t = alike.select("id", F.explode(F.array(F.lit("hot!"), F.concat(F.lit("t"), F.col("id") % 5))).alias("tag"))
    pairs = S.tag_candidates(t, t.union(t))
    assert pairs.count() == pairs.distinct().count() == 300 * 300
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_log_takes_the_rows_once(spark):
    """the recommendation ran twice, for heads and for hits."""
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        ran.add(1)
        yield from batches

    r = spark.createDataFrame([(1, 2, 1.0, 1)], "doc long, video long, score double, rank int").coalesce(1).mapInArrow(count, "doc long, video long, score double, rank int")
    titles = spark.createDataFrame([(2, "t")], "id long, title string")
    assert sorted(x["value"] for x in sinks.human_log(r, titles).collect()) == ["----------2 1.0 t", "1"]
    assert ran.value == 1

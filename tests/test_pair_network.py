import numpy as np
from pyspark.sql import functions as F

from simlane.operators import pair_network as N
from simlane.operators import pairs, scoring


def test_gradients():
    r = np.random.default_rng(0)
    m = N.network(5, 6, 2, (3, 4), 5)
    x, y = r.normal(size=(4, 5, 6, 2)), np.array([0, 1, 1, 0])
    loss = lambda: -np.log(N._forward(m, x)[0][np.arange(4), y]).mean()
    for p, g in zip(m.params, N.gradients(m, x, y), strict=True):
        assert p.shape == g.shape
        for _ in range(5):
            at = tuple(r.integers(0, s) for s in p.shape)
            kept, ends = p[at], []
            for e in (1e-5, -1e-5):
                p[at] = kept + e
                ends.append(loss())
            p[at] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - g[at]) < 1e-5


def test_pairs_can_be_told_apart(spark):
    images = spark.range(150).select("id", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(1000)) / 1000.0).alias("image"))
    t = pairs.training_set(images, "image", ["id"]).cache()
    m = N.train(t.where("idx < 120"), 8, 8, rounds=40)
    held = N.predict(t.where("idx >= 120"), m)
    assert held.count() == 60 and held.agg(scoring.accuracy(F.col("prediction"), F.col("label")[1]).alias("a")).first()["a"] > 0.8
    assert N.predict(t.where("false"), m).count() == 0

from pyspark.sql import functions as F

from simlane.operators import pair_model, pairs


def test_pairs_can_be_told_apart(spark):
    images = spark.range(120).select("id", F.transform(F.array(*[F.lit(i) for i in range(6)]), lambda i: F.pmod(F.xxhash64("id", i), F.lit(1000)) / 1000.0).alias("image"))
    t = pairs.training_set(images, "image", ["id"])
    m = pair_model.train(t, 6)
    assert pair_model.test_accuracy(m, t) > 0.95

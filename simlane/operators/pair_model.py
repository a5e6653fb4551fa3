"""A classifier of image pairs on the engine's own multilayer perceptron."""

from __future__ import annotations

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.operators.scoring import accuracy


def features(pairs: DataFrame, left: str = "left", right: str = "right", label: str = "label") -> DataFrame:
    """Pairs of equally long number arrays with a one-hot label -> features (both arrays and their distances by place)
    and label (0 the same image, 1 another)."""
    both = F.concat(left, right, F.zip_with(left, right, lambda a, b: F.abs(a - b)))
    return pairs.select(array_to_vector(F.transform(both, lambda x: x.cast("double"))).alias("features"), (F.col(label)[1]).cast("double").alias("label"))


def train(pairs: DataFrame, width: int, hidden: int = 16, rounds: int = 100, seed: int = 42) -> MultilayerPerceptronClassificationModel:
    """width: the length of one array."""
    m = MultilayerPerceptronClassifier(layers=[3 * width, hidden, 2], maxIter=rounds, seed=seed)
    return m.fit(features(pairs))


def test_accuracy(model: MultilayerPerceptronClassificationModel, pairs: DataFrame) -> float:
    return model.transform(features(pairs)).agg(accuracy(F.col("prediction"), F.col("label"))).first()[0]

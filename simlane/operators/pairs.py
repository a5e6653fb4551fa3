"""Training pairs of images: an image with its copy, and with another one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simlane.operators.sequences import numbered_rows


def one_hot(same: Column) -> Column:
    """[1, 0] for the same image, [0, 1] for another."""
    return F.when(same, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))


def scale(pixels: Column) -> Column:
    return F.transform(pixels, lambda x: x / 255.0)


def other_index(i: Column, n: int, seed: int) -> Column:
    """A number below n other than i, hashed from i and the seed by MD5."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", i.cast("string"), F.lit(str(seed)))), 1, 12), 16, 10).cast("long")
    return F.pmod(i + 1 + F.pmod(h, F.lit(max(1, n - 1))), F.lit(n))


def positive(raw: DataFrame, copy: DataFrame) -> DataFrame:
    """raw (idx, left) with copy (idx, right) of the same place."""
    return raw.join(copy, "idx").select("idx", "left", "right", one_hot(F.lit(True)).alias("label"))


def negative(raw: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """raw (idx, left) with another image of the n; none where there is only one."""
    if n < 2:
        return raw.where(F.lit(False)).select("idx", "left", F.col("left").alias("right"), one_hot(F.lit(False)).alias("label"))
    right = raw.select(F.col("idx").alias("other"), F.col("left").alias("right"))
    return raw.withColumn("other", other_index(F.col("idx"), n, seed)).join(right, "other").select("idx", "left", "right", one_hot(F.lit(False)).alias("label"))


def training_set(images: DataFrame, value: str, order: list[str], copies: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Positive and negative pairs of each image, in an order hashed from the seed. images has value and the columns of
    the order; copies (idx, right) are the images' copies, by default themselves."""
    numbered, n = numbered_rows(images, order)
    raw = numbered.select("idx", F.col(value).alias("left"))
    same = positive(raw, copies if copies is not None else raw.select("idx", F.col("left").alias("right")))
    both = same.unionByName(negative(raw, n, seed))
    return both.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("idx").cast("string"), F.col("label").cast("string"))))

"""Frame scores rolled up by video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bounds of the bands.
DANGER, WARNING, MIDDLE = 0.8, 0.5, 0.2


def band(score: Column) -> Column:
    """Service rule: over 0.8 danger, over 0.5 warning, over 0.2 middle, else safe; warnings also count as middle."""
    return F.when(score > DANGER, "danger").when(score > WARNING, "warning").when(score > MIDDLE, "middle").otherwise("safe")


def local_band(score: Column) -> Column:
    """Local rule: over 0.8 unsafe, under 0.2 safe, else middle."""
    return F.when(score > DANGER, "unsafe").when(score < MIDDLE, "safe").otherwise("middle")


def conclusions(frames: DataFrame, video: str = "video", score: str = "score", second: str = "second") -> DataFrame:
    """Per video: frames, counts by band (a warning is counted as middle too) and the seconds of danger and warning."""
    s = F.col(score)
    danger, warning, middle = s > DANGER, (s > WARNING) & (s <= DANGER), (s > MIDDLE) & (s <= DANGER)
    return frames.groupBy(F.col(video).alias("name")).agg(
        F.count("*").alias("total_count"), F.count_if(danger).alias("danger_count"), F.count_if(warning).alias("warning_count"),
        F.count_if(middle).alias("middle_count"), F.count_if(s <= MIDDLE).alias("safe_count"),
        F.array_sort(F.collect_list(F.when(danger, F.col(second)))).alias("danger_second"),
        F.array_sort(F.collect_list(F.when(warning, F.col(second)))).alias("warning_second"),
    )


def local_conclusions(frames: DataFrame, video: str = "video", score: str = "score") -> DataFrame:
    s = F.col(score)
    return frames.groupBy(F.col(video).alias("name")).agg(F.count("*").alias("total_count"), F.count_if(s > DANGER).alias("unsafe_count"), F.count_if((s <= DANGER) & (s >= MIDDLE)).alias("middle_count"), F.count_if(s < MIDDLE).alias("safe_count"))


def nsfw_score(p: Column) -> Column:
    """The second of the two class probabilities."""
    return F.element_at(p, 2)


def accuracy(predicted: Column, label: Column) -> Column:
    return F.avg((predicted == label).cast("double"))

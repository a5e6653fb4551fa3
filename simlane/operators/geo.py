"""Points and grid cells in polygons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_ring(line: Column) -> Column:
    """'lon,lat;lon,lat;...' -> array of (x, y)."""
    points = F.filter(F.split(F.trim(line), ";"), lambda p: p != "")
    return F.transform(points, lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y")))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting: an edge crosses if its ends lie on different sides of y and the crossing is right of x; left and
    bottom edges belong to the ring, right and top ones don't."""

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.when(i == 0, F.size(ring) - 1).otherwise(i - 1))
        split = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return F.when(split, x < at).otherwise(False)

    n = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(ring) - 1, F.lit(0))), F.lit(0), lambda s, i: s + F.when(crosses(i), 1).otherwise(0))
    return (F.size(ring) > 2) & (n % 2 == 1)


def boxed(polygons: DataFrame) -> DataFrame:
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    return polygons.select("*", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))


def cover(polygons: DataFrame, step: float) -> DataFrame:
    """polygons (ring, ...) with the square cells (cx, cy) of width step that they meet: each with `whole`, true if all of
    the cell is inside, when no ring is needed any more and it is null. A cell that an edge touches is border: their boxes meet and its
    corners aren't all on one side of the edge."""
    x, y = F.col("cx") * step, F.col("cy") * step
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / step), F.floor(F.col(hi) / step)))
    met = boxed(polygons).withColumn("cx", cells("x0", "x1")).withColumn("cy", cells("y0", "y1"))

    def touches(a: Column, i: Column) -> Column:
        b = F.get(F.col("ring"), F.when(i == 0, F.size("ring") - 1).otherwise(i - 1))
        near = (F.least(a["x"], b["x"]) <= x + step) & (F.greatest(a["x"], b["x"]) >= x) & (F.least(a["y"], b["y"]) <= y + step) & (F.greatest(a["y"], b["y"]) >= y)
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        sides = [dx * (v - a["y"]) - dy * (u - a["x"]) for u in (x, x + step) for v in (y, y + step)]
        slack = (F.abs(dx) + F.abs(dy)) * (F.abs(x) + F.abs(y) + step) * 1e-12
        return near & (F.least(*sides) <= slack) & (F.greatest(*sides) >= -slack)

    edges = F.size(F.filter("ring", touches))
    met = met.withColumn("border", edges > 0).where(F.col("border") | inside(F.col("ring"), x + step / 2, y + step / 2))
    return met.withColumn("whole", ~F.col("border")).withColumn("ring", F.when(F.col("border"), F.col("ring"))).drop("border", "x0", "x1", "y0", "y1")


def containing(points: DataFrame, polygons: DataFrame, keys: Sequence[str] = (), step: float = 1.0) -> DataFrame:
    """points (id, x, y, keys...) joined to polygons (code, ring, keys...) that contain them: id, code, the least code
    where several do. Polygons are covered by cells of width `step` (cover); cell and keys are the join's equality keys. A cell that
    is wholly inside needs no test; in those of the border the exact test is made."""
    cells = cover(polygons, step).select("code", "cx", "cy", "whole", "ring", *keys)
    met = points.withColumns({"cx": F.floor(F.col("x") / step), "cy": F.floor(F.col("y") / step)}).join(cells, ["cx", "cy", *keys])
    return met.where(F.col("whole") | inside(F.col("ring"), F.col("x"), F.col("y"))).groupBy("id").agg(F.min("code").alias("code"))


def locate(points: DataFrame, polygons: DataFrame, districts: Sequence[str] = (), step: float = 1.0) -> DataFrame:
    """points (id, x, y), polygons (level, parent, code, ring). First the province, then its cities only: id, code,
    kind. Codes in `districts` are districts themselves; a province without a city that matches stays a province;
    points outside all provinces have kind 'none' and no code."""
    top = containing(points, polygons.where("level = 'province'"), step=step).withColumnRenamed("code", "parent")
    known = points.join(top, "id")
    city = containing(known, polygons.where("level = 'city'"), ["parent"], step).withColumnRenamed("code", "city")
    own = F.col("parent").isin(list(districts)) if districts else F.lit(False)
    out = points.select("id").join(top, "id", "left").join(city, "id", "left")
    kind = F.when(F.col("parent").isNull(), "none").when(own, "district").when(F.col("city").isNull(), "province").otherwise("city")
    return out.select("id", F.when(own | F.col("city").isNull(), F.col("parent")).otherwise(F.col("city")).alias("code"), kind.alias("kind"))


def grid(spark: SparkSession, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    """Cells x0 <= ix < x1, y0 <= iy < y1 in hundredths of a degree: id, the key (both numbers in a row), x and y."""
    width = max(0, y1 - y0)
    cells = spark.range(max(0, x1 - x0) * width)
    ix, iy = (F.lit(x0) + F.floor(F.col("id") / max(1, width))), (F.lit(y0) + F.col("id") % max(1, width))
    return cells.select(F.concat(ix.cast("string"), iy.cast("string")).alias("id"), (ix / 100.0).alias("x"), (iy / 100.0).alias("y"))

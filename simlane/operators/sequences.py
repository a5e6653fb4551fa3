"""Ordered sequences: collapsing, change detection, sampling, batches, bag matches and greedy run matching.

Sequences are rows (vid, pos, hash); pos counts from 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simlane.operators import sequence_blocks as blocks
from simlane.operators.sequence_blocks import CELLS, longest_prefixes  # noqa: F401
from simlane.session import checkpointed


def collapse(df: DataFrame, group: str = "vid", order: str = "pos", value: str = "hash") -> DataFrame:
    """Drops values equal to the one before them and numbers the rest from 0."""
    w = Window.partitionBy(group).orderBy(order)
    kept = df.withColumn("_before", F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    kept = kept.where(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before")))
    return kept.withColumn(order, (F.row_number().over(w) - 1).cast("int")).drop("_before", "_first")


def l1(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)


def changes(df: DataFrame, threshold: float, invalid: list[str] | None = None) -> DataFrame:
    """(vid, pos, feature, hash) -> (vid, hashes): a frame is taken if its feature is further than the threshold from
    the frame before and from the last frame taken; the first frame always is. A hash in `invalid` is not given out
    and doesn't become the last one taken. The last taken frame depends on all before it, so frames are brought into order by video
    and gone through batch by batch, with two frames carried on; only the hashes of taken ones meet in a row."""
    vid, refused = df.schema["vid"].dataType.simpleString(), frozenset(invalid or ())
    ordered = df.select("vid", "pos", F.col("feature").cast("array<double>").alias("feature"), "hash").repartition("vid").sortWithinPartitions("vid", "pos")
    taken = ordered.mapInArrow(lambda batches: _taken(batches, threshold, refused), f"vid {vid}, pos long, hash string")
    frames = F.filter(F.collect_list(F.struct("pos", "hash")), lambda x: x["pos"].isNotNull())
    return taken.groupBy("vid").agg(F.transform(F.array_sort(frames), lambda x: x["hash"]).alias("hashes"))


def _taken(batches: Iterator[pa.RecordBatch], threshold: float, refused: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Taken frames of sorted ones, and of each video a row without a frame, so that none is lost."""
    now = before = key = None
    first = True
    for batch in batches:
        vids, hashes, at = batch.column("vid").to_pylist(), batch.column("hash").to_pylist(), batch.column("pos").to_pylist()
        features = [None if f is None else np.asarray(f, float) for f in batch.column("feature").to_pylist()]
        rows: list[tuple] = []
        for vid, pos, feature, h in zip(vids, at, features, hashes, strict=True):
            if first or vid != now:
                now, before, key, first = vid, None, None, False
                rows.append((vid, None, None))
            if all(x is None or (feature is not None and np.abs(feature - x).sum() > threshold) for x in (before, key)) and h is not None and h not in refused:
                key = feature
                rows.append((vid, pos, h))
            before = feature
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.schema.field("vid").type), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=["vid", "pos", "hash"])


def strip_intro(hashes: Column, intro: list[str]) -> Column:
    """Drops a known opening where the sequence begins with all of it."""
    n = len(intro)
    same = (F.size(hashes) >= n) & (F.slice(hashes, 1, n) == F.array(*[F.lit(x) for x in intro]))
    return F.when(same, F.slice(hashes, n + 1, F.greatest(F.size(hashes), F.lit(n)))).otherwise(hashes)


def sample(df: DataFrame, rate: int, interval: int, group: str = "vid", order: list[str] | None = None) -> DataFrame:
    """Every (rate x interval)-th frame with its second, index div rate. A rate of 0 has no samples."""
    w = Window.partitionBy(group).orderBy(*(order or ["pos"]))
    indexed = df.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))
    if rate <= 0 or interval <= 0:
        return indexed.where(F.lit(False)).withColumn("second", F.lit(0))
    return indexed.where(F.col("idx") % (rate * interval) == 0).withColumn("second", F.floor(F.col("idx") / rate).cast("int"))


def with_neighbour(df: DataFrame, rate: int, interval: int, value: str, group: str = "vid", order: list[str] | None = None) -> DataFrame:
    """Sampled frames with the frame that follows each, or the frame itself at the end."""
    w = Window.partitionBy(group).orderBy(*(order or ["pos"]))
    return sample(df.withColumn("copy", F.coalesce(F.lead(value).over(w), F.col(value))), rate, interval, group, order)


def batch_slice(df: DataFrame, order: list[str], start: int, size: int) -> tuple[DataFrame, int, int]:
    """Rows start .. start + size - 1 of the order, going on at the front after the last; the next start; 1 if that
    began a new round. The order's numbers come from each partition's offset, so no task sees all rows."""
    numbered, n = numbered_rows(df, order)
    if not n:
        return numbered.where(F.lit(False)), 0, 0
    take = numbered.withColumn("slot", F.pmod(F.col("idx") - start, F.lit(n)).cast("int")).where(F.col("slot") < size)
    return take, (start + size) % n, int(start + size >= n)


def numbered_rows(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """idx from 0 in the order: rows are sorted by ranges, written, counted by partition, and numbered within each. They
    are written because Spark draws the ranges anew whenever it sorts; a count of one sort is wrong for the next."""
    ranged = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(part.alias("p")).count().collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")  # a row a partition
    numbered = ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn("idx", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start"), total


def bags(queries: DataFrame, items: DataFrame) -> DataFrame:
    """(q, c, matches, covered): the sum over hashes of the times it occurs in q and in c, and the places of q whose hash
    c has. Occurrences are counted before the join, so a hash repeated within a sequence is joined once; a self match
    is left out."""
    q = queries.groupBy(F.col("vid").alias("q"), "hash").agg(F.count("*").alias("nq"))
    c = items.groupBy(F.col("vid").alias("c"), "hash").agg(F.count("*").alias("nc"))
    met = q.join(c, "hash").where(F.col("q") != F.col("c"))
    return met.groupBy("q", "c").agg(F.sum(F.col("nq") * F.col("nc")).alias("matches"), F.sum("nq").alias("covered"))


def bag_matches(queries: DataFrame, items: DataFrame) -> DataFrame:
    """(q, c, matches) of all pairs that share a hash, made block against block: no pair is shuffled."""
    q = blocks.packed(queries)
    c = q if items is queries else blocks.packed(items)
    return blocks.against(q, c, blocks.bags, "matches long").where(F.col("q") != F.col("c"))


def bag(occurrences: DataFrame) -> DataFrame:
    """(vid, hash, m, n): how often a sequence has a hash, and its length. Sequences are brought together once for both."""
    counts = occurrences.select("vid", "hash").repartition("vid").groupBy("vid", "hash").agg(F.count("*").alias("m"))
    return counts.withColumn("n", F.sum("m").over(Window.partitionBy("vid")))


def pair_counts(pairs: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    """(q, c) pairs to (q, c, nq, nc, matches, covered), the last two as bags() has them, from two bags; made for these pairs only: rows
    grow with the pairs and the different hashes of their queries, however common a hash is. Pairs without a common hash go."""
    q = queries.select(F.col("vid").alias("q"), "hash", F.col("m").alias("_q"), F.col("n").alias("nq"))
    c = items.select(F.col("vid").alias("c"), "hash", F.col("m").alias("_c"), F.col("n").alias("nc"))
    met = pairs.select("q", "c").join(q, "q").join(c, ["c", "hash"])
    return met.groupBy("q", "c", "nq", "nc").agg(F.sum(F.col("_q") * F.col("_c")).alias("matches"), F.sum("_q").alias("covered"))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, c, a, b) to (q, c, repeated, period) by the walk of run_matches."""
    for batch in batches:
        rep, per = [], []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            repeated, period = blocks.walked(a, b)
            rep.append(repeated)
            per.append(period)
        yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("c"), pa.array(rep, pa.int64()), pa.array(per, pa.int64())], names=["q", "c", "repeated", "period"])


def run_matches(queries: DataFrame, items: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(q, c, repeated, period) by greedy run matching, for the pairs (q, c) or all that share a hash; pairs
    that pair_counts has made are taken as they are, and best written before.

    L(i) is the longest run of equal hashes that starts at q's place i, anywhere in c. From place 0 on: where L > 0 it
    is added to repeated and 1 to period; the walk goes on at i + L + 1, so the place after a run is passed over, and
    c is not used up. The cells of a pair's equality matrix are as many as its matches: where these are few for the two
    lengths (CELLS), runs are islands on its diagonals; the pairs of sequences that repeat themselves, whose cells would be
    the product of the lengths, go through an automaton of c. Either way a pair's work grows with its lengths."""
    if pairs is None or not {"matches", "nq", "nc"} <= set(pairs.columns):
        some = (bags(queries, items) if pairs is None else pairs).select("q", "c").where(F.col("q") != F.col("c"))
        pairs = checkpointed(pair_counts(some, bag(queries), bag(items)))
    wanted = pairs.select("q", "c", (F.col("matches") <= CELLS * (F.col("nq") + F.col("nc"))).alias("few")).where(F.col("q") != F.col("c"))
    return _by_cells(queries, items, wanted.where("few")).unionByName(_by_automaton(queries, items, wanted.where("not few")))


def _by_automaton(queries: DataFrame, items: DataFrame, wanted: DataFrame) -> DataFrame:
    """A row holds the two sequences of a pair."""
    kinds = ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in ("q", "c"))
    listed = lambda d, ids, k, to: d.join(ids.select(F.col(k).alias("vid")).distinct(), "vid").groupBy(F.col("vid").alias(k)).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"]).alias(to))
    met = wanted.select("q", "c").join(listed(queries, wanted, "q", "a"), "q").join(listed(items, wanted, "c", "b"), "c")
    return met.select("q", "c", "a", "b").mapInArrow(_walked, f"{kinds}, repeated long, period long")


def _by_cells(queries: DataFrame, items: DataFrame, wanted: DataFrame) -> DataFrame:
    """q's places are joined to its pairs and then to c's places by c and hash; the walk is a fold over places."""
    places = queries.select(F.col("vid").alias("q"), F.col("pos").alias("i"), "hash")
    others = items.select(F.col("vid").alias("c"), F.col("pos").alias("j"), "hash")
    cells = wanted.select("q", "c").join(places, "q").join(others, ["c", "hash"])
    diagonal = Window.partitionBy("q", "c", "d").orderBy("i")
    runs = cells.select("q", "c", "i", (F.col("i") - F.col("j")).alias("d")).withColumn("island", F.col("i") - F.row_number().over(diagonal))
    end = F.max("i").over(Window.partitionBy("q", "c", "d", "island"))
    longest = runs.select("q", "c", "i", (end - F.col("i") + 1).alias("run")).groupBy("q", "c", "i").agg(F.max("run").alias("run"))
    steps = longest.groupBy("q", "c").agg(F.array_sort(F.collect_list(F.struct("i", "run"))).alias("steps"))
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("repeated"), F.lit(0).cast("long").alias("period"))

    def walk(s: Column, x: Column) -> Column:
        # places without a run move the walk on by one, so it stops at the next place with one that it hasn't passed
        hit = x["i"] >= s["pos"]
        return F.struct(F.when(hit, x["i"] + x["run"] + 1).otherwise(s["pos"]).cast("long").alias("pos"), (s["repeated"] + F.when(hit, x["run"]).otherwise(0)).cast("long").alias("repeated"), (s["period"] + F.when(hit, 1).otherwise(0)).cast("long").alias("period"))

    done = steps.select("q", "c", F.aggregate("steps", start, walk).alias("w"))
    return done.select("q", "c", F.col("w.repeated").alias("repeated"), F.col("w.period").alias("period"))

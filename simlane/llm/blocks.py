"""Blocks of vectors: the frame in which a stated query set is held against all rows.

Rows are keyed by their nearest pivot and their distance to it, and packed in that order into pages (a binary cell of at
most `rows` vectors); what a page can yield is bounded from a few numbers about it. Queries know a floor, a score that k
rows have for sure, and go only to pages whose bound reaches it, a block of them at a time. A task holds one page and one
block, neither side is broadcast or collected, and a query gets back from a page only what reaches its floor."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simlane.llm.common import pick, staged

PAGE = "page long, dim int, ids binary, vecs binary, extra binary, about binary"
HITS = "query_id long, vec_id long, score {score}"
#: Rows of a page, least and most (they grow with the table), queries routed together, and those of a block.
PAGE_ROWS, ROUTED, BLOCK_QUERIES = (8192, 65536), 512, 16384
#: Bytes about all pages up to which every routing task gets them; beyond, queries go to all pages.
ABOUT_BYTES = 32 << 20
#: Rows of the sample that pivots and first floors are taken from, and pivots.
SAMPLE_ROWS, PIVOTS = 2048, 32


def vectors(df: DataFrame, zero: bool) -> DataFrame:
    """vec_id and the vector as doubles, where it is whole: not null or empty, all components finite; without the zero
    vector unless zero is set. Rows with a null id can't be reported and take no part; of rows that share an id the
    smallest vector counts."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    ok = v.isNotNull() & (F.size(v) > 0) & ~bad
    clean = pick(df, "vec_id", "embedding").where(F.col("vec_id").isNotNull()).select("vec_id", v.alias("v"), (ok if zero else ok & some).alias("ok"))
    return clean.where("ok").groupBy("vec_id").agg(F.min("v").alias("v"))


def matrices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Table]]:
    """Ids, vectors and the rows of at most `rows` rows of one dimension, in the order they come."""

    def cut(t: pa.Table):
        sizes = t["v"].combine_chunks().value_lengths().to_numpy()
        ids = t["vec_id"].to_numpy()
        for d in np.unique(sizes):
            own = np.flatnonzero(sizes == d)
            part = t.take(pa.array(own))
            flat = part["v"].combine_chunks().flatten().to_numpy()
            yield ids[own], flat.reshape(len(own), int(d)), part

    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        while b.num_rows:
            now = b.slice(0, rows - n)
            b = b.slice(now.num_rows)
            held.append(now)
            n += now.num_rows
            if n == rows:
                yield from cut(pa.Table.from_batches(held))
                held, n = [], 0
    if held:
        yield from cut(pa.Table.from_batches(held))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T))


def choose_pivots(sample: np.ndarray, pivots: int, rounds: int = 5) -> np.ndarray:
    """Means of groups of the sample: starts far apart, then moves each to its group's mean."""
    p = sample[:1]
    gap = ((sample - p[0]) ** 2).sum(axis=1)
    while len(p) < min(pivots, len(sample)) and gap.max() > 0:
        p = np.vstack([p, sample[int(gap.argmax())]])
        gap = np.minimum(gap, ((sample - p[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        near = distances(sample, p).argmin(axis=1)
        p = np.array([sample[near == i].mean(axis=0) if (near == i).any() else p[i] for i in range(len(p))])
    return p


def sampled(rows: DataFrame, sample_rows: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension the ids and vectors of at most sample_rows rows, those of least hash."""
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r["v"]) for r in taken}:
        own = [r for r in taken if len(r["v"]) == d]
        by[d] = np.array([r["vec_id"] for r in own]), np.array([r["v"] for r in own])
    return by


def page_rows(n: int) -> int:
    """Rows of a page of a table of n: larger ones where there are many, as each page meets each block it can answer."""
    return min(PAGE_ROWS[1], max(PAGE_ROWS[0], n // 64))


def pages(rows: DataFrame, n: int, most: int, centres: dict[int, np.ndarray], lift: Callable[[np.ndarray], np.ndarray], build: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[bytes, bytes]]) -> DataFrame:
    """Pages of the n rows (vec_id, v) in the order of nearest pivot, distance to it and id. lift gives the vectors as
    distances are taken, build (vectors, pivots, distances) more bytes of a page and those about it."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v, _ in matrices(batches, 4096):
            dist = distances(lift(v), centres.get(v.shape[1], np.zeros((1, lift(v[:1]).shape[1]))))
            near = dist.argmin(axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32)), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), lists, pa.array(near.astype(np.int32)), pa.array(dist[np.arange(len(ids)), near])], names=["vec_id", "v", "pivot", "dist"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for ids, v, part in matrices(batches, most):
            extra, about = build(v, part["pivot"].to_numpy(), part["dist"].to_numpy())
            yield pa.RecordBatch.from_pydict({
                "page": pa.array([at], pa.int64()), "dim": pa.array([v.shape[1]], pa.int32()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "vecs": pa.array([np.ascontiguousarray(v, np.float64).tobytes()], pa.binary()), "extra": pa.array([extra], pa.binary()), "about": pa.array([about], pa.binary()),
            })
            at += 1

    order = ["pivot", "dist", "vec_id"]
    keys = rows.mapInArrow(keyed, "vec_id long, v array<double>, pivot int, dist double")
    return staged(keys.repartitionByRange(max(1, -(-n // most)), *order).sortWithinPartitions(*order).mapInArrow(packed, PAGE))


def floors(asked: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int, product: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """asked (vec_id, v) with floor, a score that k rows of the sample other than the query's own reach, else -inf, and
    with these rows' ids and scores as known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v, part in matrices(batches, 1024):
            known, matrix = sample.get(v.shape[1], (np.zeros(0, np.int64), np.zeros((0, v.shape[1]))))
            floor, rows = np.full(len(ids), -np.inf), []
            for i, own in enumerate(ids):
                have = product(matrix, v[i])
                top = best(known[known != own], have[known != own], k)
                rows.append([{"id": int(a), "score": float(b)} for a, b in zip(*top, strict=True)])
                if len(top[0]) == k:
                    floor[i] = top[1][-1]
            # a score that a double can't hold is rounded down
            floor -= np.where(np.isfinite(floor), np.abs(floor), 0.0) * 2.0**-50
            pairs = pa.array(rows, pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([pa.array(ids), part["v"].combine_chunks(), pa.array(floor), pairs], names=["vec_id", "v", "floor", "known"])

    return asked.mapInArrow(run, "vec_id long, v array<double>, floor double, known array<struct<id:bigint,score:double>>")


def search(data: DataFrame, asked: DataFrame, k: int, score: str, reach: Callable[[np.ndarray, list[bytes]], np.ndarray], find: Callable[[dict, dict], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """The k best rows of each query over all pages: query_id, rank, vec_id, score; highest score first, ties to the
    smaller id. asked is from floors(); where scores are doubles the rows known from there count as found. reach bounds the scores of queries in pages (queries x pages) from what is
    known about these; find yields (query id, vec ids, scores) of a page. First each query is held against the page
    that promises most, which lifts its floor; then against all others that can still reach it."""
    n_pages, size = data.agg(F.count("*"), F.sum(F.octet_length("about") + 16)).first()
    n = asked.count()
    blocks = max(1, -(-n // BLOCK_QUERIES))
    known = None
    if (size or 0) <= ABOUT_BYTES:
        known = {}
        for r in data.select("page", "dim", "about").collect():
            known.setdefault(r["dim"], ([], []))[0].append(r["page"])
            known[r["dim"]][1].append(bytes(r["about"]))
    kind = pa.float64() if score == "double" else pa.int64()
    routed = "g long, block int, q_dim int, q_ids binary, q_vecs binary, q_floors binary"

    def route(best: bool, bare: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Queries by the pages they go to, those of a row with a number; bare: only how many go to each page."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            seq, asks = TaskContext.get().partitionId(), Counter()
            for ids, v, part in matrices(batches, ROUTED):
                floor = part["floor"].to_numpy()
                seq += 1
                if known is None:
                    goes = [(g, np.arange(len(ids))) for g in range(n_pages)]
                else:
                    at, about = known.get(v.shape[1], ([], []))
                    bound = reach(v, about) if at else np.zeros((len(ids), 0))
                    top = bound.argmax(axis=1) if at else None
                    goes = []
                    for j, g in enumerate(at):
                        own = np.flatnonzero(top == j) if best else np.flatnonzero((bound[:, j] >= floor) & (top != j))
                        if len(own):
                            goes.append((g, own))
                if bare:
                    asks.update({g: len(own) for g, own in goes})
                    continue
                for g, own in goes:
                    yield pa.RecordBatch.from_pydict({
                        "g": pa.array([g], pa.int64()), "block": pa.array([seq], pa.int32()), "q_dim": pa.array([v.shape[1]], pa.int32()), "q_ids": pa.array([ids[own].astype(np.int64).tobytes()], pa.binary()),
                        "q_vecs": pa.array([np.ascontiguousarray(v[own]).tobytes()], pa.binary()), "q_floors": pa.array([floor[own].tobytes()], pa.binary()),
                    })
            if bare and asks:
                yield pa.RecordBatch.from_arrays([pa.array(list(asks), pa.int64()), pa.array(list(asks.values()), pa.int64())], names=["page", "n"])

        return run

    def met(pages: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        some = queries.to_pylist()
        for i in range(pages.num_rows if some else 0):
            p = {c: pages[c][i].as_py() for c in ("dim", "ids", "vecs", "extra")}
            own = [r for r in some if r["q_dim"] == p["dim"]]
            if not own:
                continue
            ids = np.frombuffer(p["ids"], np.int64)
            x = {"ids": ids, "vecs": np.frombuffer(p["vecs"]).reshape(len(ids), -1), "dim": p["dim"], "extra": p["extra"]}
            q = {"ids": np.frombuffer(b"".join(r["q_ids"] for r in own), np.int64), "vecs": np.frombuffer(b"".join(r["q_vecs"] for r in own)).reshape(-1, p["dim"]), "floors": np.frombuffer(b"".join(r["q_floors"] for r in own)), "dim": p["dim"]}
            found += [(np.full(len(v), o, np.int64), v, s) for o, v, s in find(x, q)]
        empty = [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*found, strict=True) if found else [[e] for e in empty], (pa.int64(), pa.int64(), kind), strict=True)], names=["query_id", "vec_id", "score"])

    def hits(asked: DataFrame, best: bool) -> DataFrame:
        """A page goes once to each block of the queries that ask for it, and has as many blocks as these fill."""
        queries = asked.select("vec_id", "v", "floor")
        right = queries.mapInArrow(route(best, False), routed)
        if known is None:
            g = F.pmod(F.xxhash64("page"), F.lit(max(1, n_pages)))
            left = data.select(g.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "dim", "ids", "vecs", "extra")
            right = right.withColumn("block", F.pmod("block", F.lit(blocks)))
        else:
            # a row a page that is asked for, of which there are fewer than bytes in ABOUT_BYTES / 16
            full = staged(queries.mapInArrow(route(best, True), "page long, n long").groupBy("page").agg(F.ceil(F.sum("n") / BLOCK_QUERIES).cast("int").alias("full")))
            left = data.join(F.broadcast(full), "page").select(F.col("page").alias("g"), F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("block"), "dim", "ids", "vecs", "extra")
            right = right.join(F.broadcast(full), F.col("g") == F.col("page")).withColumn("block", F.pmod("block", "full")).drop("page", "full")
        return left.groupBy("g", "block").cogroup(right.groupBy("g", "block")).applyInArrow(met, HITS.format(score=score))

    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())

    def ranked(found: DataFrame) -> DataFrame:
        if score == "double":
            sure = asked.select(F.col("vec_id").alias("query_id"), F.inline("known")).toDF("query_id", "vec_id", "score")
            found = found.unionByName(sure).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    if known is None:
        return ranked(hits(asked, False))
    first = staged(ranked(hits(asked, True)))
    low = F.col("score").cast("double")
    lifted = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), (low - F.abs(low) * 2.0**-50).alias("reached"))
    # written, as it is routed twice: its rows have to come in the same order
    now = asked.join(lifted, "vec_id", "left").select("vec_id", "v", F.greatest("floor", F.coalesce("reached", F.lit(float("-inf")))).alias("floor"))
    return ranked(first.drop("rank").unionByName(hits(staged(now), False)))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best in order: highest score, then smallest id."""
    if len(ids) > 4 * k:
        own = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        ids, scores = ids[own], scores[own]
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]

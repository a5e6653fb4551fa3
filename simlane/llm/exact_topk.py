"""Exact top-k search with a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it and kept in that order; a run of the order is an
annulus around a pivot. A query goes only to pages of the order whose annuli can reach its floor by the triangle inequality
(blocks.search); of these it takes annuli by the best score that it leaves them and stops when that can't reach its k-th score. An added component makes all vectors equally long, so that the largest inner
product is the smallest distance: |q - x|^2 = |q|^2 + M^2 - 2<q, x>."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm import blocks
from simlane.llm.blocks import distances
from simlane.llm.common import staged

#: Rows of an annulus.
RING = 256


def whole_numbers(v):
    """floor(1024 * x) of each component, as a double that holds a whole number."""
    return F.transform(v, lambda x: F.floor(x * 1024).cast("double"))


def products(v: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products of the rows of v with q; doubles hold them exactly where exact is set."""
    if exact:
        return (v @ q).astype(np.int64)
    return (v.astype(np.int64) * q.astype(np.int64)).sum(axis=1)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 10, pivots: int = blocks.PIVOTS, sample_rows: int = blocks.SAMPLE_ROWS, page_rows: int | None = None) -> DataFrame:
    """The k rows of highest integer inner product for each query, its own row left out: query_id, rank, vec_id and
    score (long). Both inputs have vec_id and embedding.

    Pivots are fitted on at most sample_rows rows, chosen by hash; every whole vector is indexed (blocks.vectors says
    which take no part) and the result is exact. The sample also gives each query its first floor. Equal vectors in any
    number spread over pages, as the order of the index goes on by id. Scores are exact while below 2^63. Fewer than k
    candidates give fewer rows; an empty table gives none; a query meets vectors of its own dimension only."""
    rows = staged(blocks.vectors(embeddings, zero=True).select("vec_id", whole_numbers(F.col("v")).alias("v")))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, most = rows.agg(F.count("*"), F.max(norm)).first()
    most = float(most or 0.0)
    exact = most < 2.0**52
    far = np.sqrt(max(most, 1.0)) * 1e-6

    def lifted(v: np.ndarray) -> np.ndarray:
        return np.c_[v, np.sqrt(np.maximum(0.0, most - (v**2).sum(axis=1)))]

    sample = blocks.sampled(rows, sample_rows)
    centres = {d: blocks.choose_pivots(lifted(s), pivots) for d, (_, s) in sample.items()}

    def annuli(pivot: np.ndarray, dist: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of runs of one pivot, of at most so many rows."""
        starts = np.unique(np.r_[np.arange(0, len(pivot), size), np.flatnonzero(np.diff(pivot)) + 1])
        return starts, np.r_[starts[1:], len(pivot)]

    def bounds(q: np.ndarray, pivot: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """The highest score that the triangle inequality leaves queries in annuli."""
        p = centres.get(q.shape[1], np.zeros((1, q.shape[1] + 1)))
        to = distances(np.c_[q, np.zeros(len(q))], p)[:, pivot]
        gap = np.maximum(0.0, np.maximum(inner[None, :] - to, to - outer[None, :]) - far)
        return ((q**2).sum(axis=1)[:, None] + most - gap**2) / 2 + far * (1 + far)

    def build(v: np.ndarray, pivot: np.ndarray, dist: np.ndarray) -> tuple[bytes, bytes]:
        s, e = annuli(pivot, dist, len(pivot))
        return pivot.astype(np.float64).tobytes() + dist.tobytes(), np.c_[pivot[s], dist[s], dist[e - 1]].astype(np.float64).tobytes()

    def reach(q: np.ndarray, about: list[bytes]) -> np.ndarray:
        m = np.frombuffer(b"".join(about)).reshape(-1, 3)
        begins = np.cumsum([0, *[len(x) // 24 for x in about[:-1]]])
        return np.maximum.reduceat(bounds(q, m[:, 0].astype(int), m[:, 1], m[:, 2]), begins, axis=1)

    def find(x: dict, q: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        m = len(x["ids"])
        pivot, dist = np.frombuffer(x["extra"], np.float64, m).astype(int), np.frombuffer(x["extra"], np.float64, m, 8 * m)
        starts, ends = annuli(pivot, dist, RING)
        for lo in range(0, len(q["ids"]), 1024):
            some = q["vecs"][lo : lo + 1024]
            bound = bounds(some, pivot[starts], dist[starts], dist[ends - 1])
            for i, own in enumerate(q["ids"][lo : lo + 1024]):
                floor = q["floors"][lo + i]
                got_ids, got = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for j in np.argsort(-bound[i], kind="stable"):
                    if bound[i, j] < floor:
                        break
                    s = slice(int(starts[j]), int(ends[j]))
                    p, ids = products(x["vecs"][s], some[i], exact), x["ids"][s]
                    keep = (ids != own) & (p >= floor)
                    if keep.any():
                        got_ids, got = blocks.best(np.r_[got_ids, ids[keep]], np.r_[got, p[keep]], k)
                        if len(got) == k:
                            floor = max(floor, float(got[-1]) - abs(float(got[-1])) * 2.0**-50)
                if len(got):
                    yield int(own), got_ids, got

    data = blocks.pages(rows, n, page_rows or blocks.page_rows(n), centres, lifted, build)
    asked = blocks.vectors(queries, zero=True).select("vec_id", whole_numbers(F.col("v")).alias("v"))
    asked = staged(blocks.floors(asked, sample, k, lambda m, q: products(m, q, exact).astype(np.float64)))
    return blocks.search(data, asked, k, "long", reach, find)

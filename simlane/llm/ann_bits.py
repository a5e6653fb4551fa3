"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is kept as the signs of its rotated residual from its page's mean, one bit a dimension, with two correction
scalars: the residual's length and its inner product with the code. From the packed bits and a query rounded to eight
bits the inner product is estimated, with an error bound; only vectors whose upper bound reaches the query's floor or
what the page has for it are scored exactly. Pages hold vectors near one pivot, so that residuals are short, and a
query goes only to pages that can reach its floor (blocks.search)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm import blocks
from simlane.llm.common import staged

PLANES = 8
#: Estimates made at once.
CELLS = 1 << 19


def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def width(dim: int) -> int:
    return -(-dim // 64) * 64


def rotated(v: np.ndarray, seed: int) -> np.ndarray:
    w = width(v.shape[1])
    return np.pad(v, ((0, 0), (0, w - v.shape[1]))) @ rotation(w, seed)


def encode(v: np.ndarray, seed: int) -> bytes:
    """The page's mean, the residuals' lengths, their inner products with their codes, and the codes as 64-bit words."""
    mean = v.mean(axis=0)
    o = rotated(v - mean, seed)
    w = o.shape[1]
    r = np.linalg.norm(o, axis=1)
    f = np.abs(o).sum(axis=1) / (np.sqrt(w) * np.where(r > 0, r, 1))
    codes = np.packbits(o > 0, axis=1, bitorder="little")
    return mean.tobytes() + r.tobytes() + np.where(r > 0, f, 1).tobytes() + np.ascontiguousarray(codes).tobytes()


def decode(extra: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    head = np.frombuffer(extra, np.float64, dim + 2 * n)
    codes = np.frombuffer(extra, np.uint64, offset=8 * (dim + 2 * n)).reshape(n, -1)
    return head[:dim], head[dim : dim + n], head[dim + n :], codes


def estimate(q: np.ndarray, mean: np.ndarray, r: np.ndarray, f: np.ndarray, codes: np.ndarray, seed: int, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their error bounds."""
    rot = rotated(q, seed)
    w = rot.shape[1]
    low = rot.min(axis=1)
    step = (rot.max(axis=1) - low) / (2**PLANES - 1)
    step[step == 0] = 1.0
    u = np.rint((rot - low[:, None]) / step[:, None]).astype(np.uint16)
    bits = np.zeros((len(q), len(codes)), np.float64)
    for p in range(PLANES):
        plane = np.packbits((u >> p) & 1, axis=1, bitorder="little").view(np.uint64)
        hit = sum(np.bitwise_count(plane[:, j, None] & codes[None, :, j]).astype(np.uint16) for j in range(codes.shape[1]))
        bits += hit * float(1 << p)
    ones = np.bitwise_count(codes).sum(axis=1)
    positive = low[:, None] * ones[None, :] + step[:, None] * bits
    rounded = low * w + step * u.sum(axis=1)
    on_code = (2 * positive - rounded[:, None]) / np.sqrt(w)
    est = (q @ mean)[:, None] + (r / f)[None, :] * on_code
    spread = r * np.sqrt(np.maximum(0.0, 1 - f**2)) / f * eps / np.sqrt(max(1, w - 1))
    err = np.linalg.norm(q, axis=1)[:, None] * spread[None, :] + (r / f)[None, :] * (step * np.sqrt(w) / 2)[:, None]
    return est, err


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 20, eps: float = 1.9, seed: int = 42, page_rows: int | None = None, pivots: int = blocks.PIVOTS, sample_rows: int = blocks.SAMPLE_ROWS) -> DataFrame:
    """The k rows of largest inner product found for each query, its own row left out: query_id, rank, vec_id, score
    (exact, on the original vectors, in double precision). Both inputs have vec_id and embedding.

    Every whole vector is indexed; see blocks.vectors for those that take no part. Pivots and first floors come from at
    most sample_rows rows. A query meets vectors of its own dimension only. eps widens the error bounds: a neighbour is
    lost only if its estimate is off by more. Fewer than k candidates give fewer rows; equal scores go to the smaller
    id; an empty table gives no rows."""
    rows = staged(blocks.vectors(embeddings, zero=False))
    n = rows.count()
    sample = blocks.sampled(rows, sample_rows)
    centres = {d: blocks.choose_pivots(v, pivots) for d, (_, v) in sample.items()}

    def build(v: np.ndarray, pivot: np.ndarray, dist: np.ndarray) -> tuple[bytes, bytes]:
        starts = np.r_[0, np.flatnonzero(np.diff(pivot)) + 1]
        about = []
        for part in np.split(v, starts[1:]):
            mean = part.mean(axis=0)
            about.append(np.r_[mean, np.linalg.norm(part - mean, axis=1).max()])
        return encode(v, seed), np.array(about).tobytes()

    def reach(q: np.ndarray, about: list[bytes]) -> np.ndarray:
        """The product with the mean of a page's vectors of one pivot, and as much as the farthest of them can add."""
        width = q.shape[1] + 1
        m = np.frombuffer(b"".join(about)).reshape(-1, width)
        begins = np.cumsum([0, *[len(x) // (8 * width) for x in about[:-1]]])
        bound = q @ m[:, :-1].T + np.linalg.norm(q, axis=1)[:, None] * m[None, :, -1]
        return np.maximum.reduceat(bound + np.abs(bound) * 1e-9, begins, axis=1)

    def find(x: dict, q: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        parts = decode(x["extra"], len(x["ids"]), x["dim"])
        ids, v = x["ids"], x["vecs"]
        step = max(1, CELLS // len(ids))
        for lo in range(0, len(q["ids"]), step):
            qv = q["vecs"][lo : lo + step]
            est, err = estimate(qv, *parts, seed, eps)
            for i, own in enumerate(q["ids"][lo : lo + step]):
                e = np.where(ids == own, -np.inf, est[i])
                some = min(len(ids), 2 * k)
                top = np.argpartition(e, len(e) - some)[len(e) - some :]
                exact = v[top] @ qv[i]
                exact[ids[top] == own] = -np.inf
                reached = np.partition(exact, some - k)[some - k] if some > k else -np.inf
                floor = q["floors"][lo + i]
                at = np.union1d(np.flatnonzero((e + err[i] >= max(reached, floor)) & (ids != own)), top[(ids[top] != own) & (exact >= floor)])
                p = v[at] @ qv[i]
                at, p = at[p >= floor], p[p >= floor]
                if len(at):
                    yield int(own), *blocks.best(ids[at], p, k)

    data = blocks.pages(rows, n, page_rows or blocks.page_rows(n), centres, lambda v: v, build)
    asked = staged(blocks.floors(blocks.vectors(queries, zero=False), sample, k, lambda m, q: m @ q))
    return blocks.search(data, asked, k, "double", reach, find)

"""A convolutional network on image pairs, in numpy: both images are stacked as channels, blocks of a 3 x 3 convolution,
a rectifier and a 2 x 2 maximum follow, then a hidden layer and two classes. Fitted on the driver on a bounded sample,
applied on the executors in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs that the network is fitted on at most, those of least hash.
SAMPLE_PAIRS = 4096


@dataclass
class Network:
    """Kernels (9 x in, out) and biases of each block, then weights and bias of the hidden and of the output layer."""

    height: int
    width: int
    params: list[np.ndarray]


def network(height: int, width: int, channels: int, filters: tuple[int, ...] = (8, 16), hidden: int = 32, seed: int = 42) -> Network:
    """With random weights; height and width are of one image, channels of both together."""
    r = np.random.default_rng(seed)
    params, h, w, c = [], height, width, channels
    for f in filters:
        params += [r.normal(0, np.sqrt(2 / (9 * c)), (9 * c, f)), np.zeros(f)]
        h, w, c = h // 2, w // 2, f
    n = max(1, h * w * c)
    return Network(height, width, [*params, r.normal(0, np.sqrt(2 / n), (n, hidden)), np.zeros(hidden), r.normal(0, np.sqrt(1 / hidden), (hidden, 2)), np.zeros(2)])


def _columns(x: np.ndarray) -> np.ndarray:
    """(n, h, w, c) -> (n, h, w, 9 c): each place with its neighbours, zeros around the image."""
    p = np.pad(x, ((0, 0), (1, 1), (1, 1), (0, 0)))
    return sliding_window_view(p, (3, 3), axis=(1, 2)).transpose(0, 1, 2, 4, 5, 3).reshape(*x.shape[:3], -1)


def _forward(m: Network, x: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Probabilities, and what the way back needs."""
    kept = []
    blocks = (len(m.params) - 4) // 2
    for b in range(blocks):
        cols = _columns(x)
        on = np.maximum(0, cols @ m.params[2 * b] + m.params[2 * b + 1])
        n, h, w, c = on.shape
        cells = on[:, : h // 2 * 2, : w // 2 * 2].reshape(n, h // 2, 2, w // 2, 2, c).transpose(0, 1, 3, 5, 2, 4).reshape(n, h // 2, w // 2, c, 4)
        best = cells.argmax(axis=-1)
        out = np.take_along_axis(cells, best[..., None], -1)[..., 0]
        kept.append((cols, on, best, x.shape))
        x = out
    flat = x.reshape(len(x), -1)
    hidden = np.maximum(0, flat @ m.params[-4] + m.params[-3])
    z = hidden @ m.params[-2] + m.params[-1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    kept.append((flat, hidden, x.shape))
    return p / p.sum(axis=1, keepdims=True), kept


def gradients(m: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, in the order of the parameters; y has the classes."""
    p, kept = _forward(m, x)
    d = p.copy()
    d[np.arange(len(y)), y] -= 1
    d /= len(y)
    flat, hidden, shape = kept[-1]
    tail = [hidden.T @ d, d.sum(axis=0)]
    d = (d @ m.params[-2].T) * (hidden > 0)
    tail = [flat.T @ d, d.sum(axis=0), *tail]
    d = (d @ m.params[-4].T).reshape(shape)
    front: list[np.ndarray] = []
    for b in reversed(range((len(m.params) - 4) // 2)):
        cols, on, best, before = kept[b]
        n, h, w, c = on.shape
        cells = np.zeros((*best.shape, 4))
        np.put_along_axis(cells, best[..., None], d[..., None], -1)
        full = np.zeros_like(on)
        full[:, : h // 2 * 2, : w // 2 * 2] = cells.reshape(n, h // 2, w // 2, c, 2, 2).transpose(0, 1, 4, 2, 5, 3).reshape(n, h // 2 * 2, w // 2 * 2, c)
        full *= on > 0
        front = [np.tensordot(cols, full, axes=([0, 1, 2], [0, 1, 2])), full.sum(axis=(0, 1, 2)), *front]
        if b:
            back = (full @ m.params[2 * b].T).reshape(n, h, w, 3, 3, before[-1])
            padded = np.zeros((n, h + 2, w + 2, before[-1]))
            for i in range(3):
                for j in range(3):
                    padded[:, i : i + h, j : j + w] += back[:, :, :, i, j]
            d = padded[:, 1:-1, 1:-1]
    return [*front, *tail]


def fit(m: Network, x: np.ndarray, y: np.ndarray, rounds: int = 30, batch: int = 32, rate: float = 0.003, seed: int = 42) -> Network:
    """Adam over batches in a new random order each round; the network is changed in place."""
    r, step = np.random.default_rng(seed), 0
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in m.params]
    for _ in range(rounds):
        order = r.permutation(len(y))
        for lo in range(0, len(y), batch):
            own = order[lo : lo + batch]
            step += 1
            for p, g, (a, b) in zip(m.params, gradients(m, x[own], y[own]), moment, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return m


def stacked(left: np.ndarray, right: np.ndarray, height: int, width: int) -> np.ndarray:
    """Two lists of flat images (values 0 .. 1) as one array (n, height, width, channels of both)."""
    return np.concatenate([np.stack([np.asarray(i, np.float64) for i in side]).reshape(len(side), height, width, -1) for side in (left, right)], axis=-1)


def train(pairs: DataFrame, height: int, width: int, sample_pairs: int = SAMPLE_PAIRS, **how) -> Network:
    """Fitted on at most sample_pairs rows (idx, left, right, label one-hot), those of least hash; flat images of one size."""
    rows = pairs.orderBy(F.xxhash64("idx", "label"), "idx").limit(sample_pairs).select("left", "right", F.col("label")[1].alias("y")).collect()
    x = stacked([r["left"] for r in rows], [r["right"] for r in rows], height, width)
    return fit(network(height, width, x.shape[-1]), x, np.array([r["y"] for r in rows]), **how)


def predict(pairs: DataFrame, m: Network) -> DataFrame:
    """Adds prediction: 0 for the same image, 1 for another."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            x = stacked(pdf["left"], pdf["right"], m.height, m.width) if len(pdf) else np.zeros((0, m.height, m.width, 2))
            yield pdf.assign(prediction=_forward(m, x)[0].argmax(axis=1) if len(pdf) else np.zeros(0, int))

    return pairs.mapInPandas(run, f"{kinds}, prediction int")

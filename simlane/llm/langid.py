"""Language identification by a bidirectional gated recurrent network over bytes, trained here by backpropagation
through time in numpy. It labels every byte; a document's probabilities are the means over its bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simlane.llm.common import frugal, held_out, pick, staged

#: Bounds of the training sample: documents of each language by hash, and windows of all languages together, each language
#: having its equal part of them (WINDOWS_EACH at least).
SAMPLE_DOCS, SAMPLE_WINDOWS, WINDOWS_EACH = 300, 200_000, 100
#: Languages up to which a table with a row for each is broadcast.
BROADCAST_LANGS = 10_000
#: Bytes of a training window and of a window of a text; a text is labelled in windows, each with states of its own.
TRAIN_BYTES, WINDOW_BYTES = 64, 256
HIDDEN, STEPS, BATCH, RATE = 8, 200, 256, 0.02
#: Windows run at once.
LANES = 4096


@dataclass
class Model:
    """Per direction: inputs (3H x 256, a byte's share of update, reset and candidate), recurrent (3H x H) and output
    (K x H) weights; the outputs' bias."""

    langs: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: list[np.ndarray]
    bias: np.ndarray


def _gates(g: np.ndarray, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turns g, the recurrent terms, into update and reset (first rows) and candidate (last rows) in place."""
    k = len(h)
    zr = g[: 2 * k]
    zr += x[: 2 * k]
    zr *= 0.5
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    n = g[2 * k :]
    n *= zr[k:]
    n += x[2 * k :]
    np.tanh(n, out=n)
    return zr[:k], zr[k:], n


def position_logits(m: Model, x: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Logits (T x K x N) of the bytes x (T x N); columns are ordered by falling length, active[t] of them reach t."""
    steps, lanes = x.shape
    k = m.recurrent[0].shape[1]
    out = np.empty((steps, len(m.langs), lanes), np.float32)
    out[:] = m.bias[None, :, None]
    for way, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
        h = np.zeros((k, lanes), np.float32)
        for t in order:
            n_on = int(active[t])
            if not n_on:
                continue
            on = h[:, :n_on]
            g = m.recurrent[way] @ on
            z, _, n = _gates(g, np.take(m.inputs[way], x[t, :n_on], axis=1), on)
            on -= n
            on *= z
            on += n
            out[t, :, :n_on] += m.output[way] @ on
    return out


def _cut(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as columns of bytes, and how many reach each step; lengths fall."""
    steps = int(lengths[0])
    at = np.minimum(starts[None, :] + np.arange(steps)[:, None], max(0, len(data) - 1))
    return data[at], np.searchsorted(-lengths, -np.arange(steps), side="left")


def document_probabilities(m: Model, texts: list[str | None], window: int = WINDOW_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Per text the mean of its bytes' probabilities, and the number of bytes labelled with each language."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    first = np.r_[0, np.cumsum(sizes)[:-1]] if len(sizes) else sizes
    n = -(-sizes // window)
    doc = np.repeat(np.arange(len(raw)), n)
    place = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
    starts, lengths = first[doc] + place, np.minimum(window, sizes[doc] - place)
    total, labels = np.zeros((len(raw), len(m.langs))), np.zeros((len(raw), len(m.langs)), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for lo in range(0, len(order), LANES):
        own = order[lo : lo + LANES]
        x, active = _cut(data, starts[own], lengths[own])
        p = position_logits(m, x, active)
        on = np.arange(len(own))[None, :] < active[:, None]
        best = np.where(on, p.argmax(axis=1), -1)
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        p *= on[:, None, :]
        mean = p.sum(axis=0, dtype=np.float64)
        for k in range(len(m.langs)):
            total[:, k] += np.bincount(doc[own], mean[k], minlength=len(raw))
            labels[:, k] += np.bincount(doc[own], (best == k).sum(axis=0), minlength=len(raw)).astype(np.int64)
    return total / np.maximum(1, sizes)[:, None], labels


def train(windows: list[bytes], langs: list[str], steps: int = STEPS, batch: int = BATCH, hidden: int = HIDDEN, rate: float = RATE, seed: int = 42) -> Model:
    """Fits the network to windows of bytes and their languages: each byte is to be labelled with its window's language.
    Batches hold the languages in equal parts."""
    names = sorted(set(langs))
    r = np.random.default_rng(seed)
    k, h3 = len(names), 3 * hidden
    f = np.float32
    m = Model(names, [r.normal(0, 0.3, (h3, 256)).astype(f) for _ in range(2)], [r.normal(0, 0.5 / np.sqrt(hidden), (h3, hidden)).astype(f) for _ in range(2)], [r.normal(0, 0.3, (k, hidden)).astype(f) for _ in range(2)], np.zeros(k, f))
    if k < 2:
        return m
    by = [np.array([i for i, x in enumerate(langs) if x == n]) for n in names]
    data = np.frombuffer(b"".join(windows), np.uint8)
    sizes = np.array([len(w) for w in windows])
    first = np.cumsum(sizes) - sizes
    params = [*m.inputs, *m.recurrent, *m.output, m.bias]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        rows = np.concatenate([r.choice(b, -(-batch // k)) for b in by])
        y = np.repeat(np.arange(k), -(-batch // k))
        order = np.argsort(-sizes[rows], kind="stable")
        rows, y = rows[order], y[order]
        x, active = _cut(data, first[rows], sizes[rows])
        grads = _gradients(m, x, active, y)
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (a, b) in zip(params, grads, moment, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return m


def _gradients(m: Model, x: np.ndarray, active: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over bytes, for inputs, recurrent and output weights of both ways and the bias."""
    steps, lanes = x.shape
    hidden, k = m.recurrent[0].shape[1], len(m.langs)
    on = (np.arange(lanes)[None, :] < active[:, None]).astype(np.float32)
    ways = ((0, range(steps)), (1, range(steps - 1, -1, -1)))
    logits = np.empty((steps, k, lanes), np.float32)
    logits[:] = m.bias[None, :, None]
    kept: list[dict] = [{}, {}]
    for way, order in ways:
        h = np.zeros((hidden, lanes), np.float32)
        for t in order:
            g = m.recurrent[way] @ h
            recurrent_n = g[2 * hidden :].copy()
            z, reset, n = _gates(g, m.inputs[way][:, x[t]], h)
            new = (n + z * (h - n)) * on[t]
            kept[way][t] = (h, z, reset, n, recurrent_n, new)
            h = new
            logits[t] += m.output[way] @ h
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[:, y, np.arange(lanes)] -= 1
    p *= on[:, None, :] / max(1.0, on.sum())
    grads: list[list[np.ndarray]] = [[], [], []]
    for way, order in ways:
        d_rec, d_out = np.zeros_like(m.recurrent[way]), np.zeros_like(m.output[way])
        d_in = np.zeros((steps, 3 * hidden, lanes), np.float32)
        back = np.zeros((hidden, lanes), np.float32)
        for t in reversed(order):
            h, z, reset, n, recurrent_n, new = kept[way][t]
            d_out += p[t] @ new.T
            d = (back + m.output[way].T @ p[t]) * on[t]
            d_n = d * (1 - z) * (1 - n * n)
            d_z = d * (h - n) * z * (1 - z)
            d_r = d_n * recurrent_n * reset * (1 - reset)
            g = np.concatenate([d_z, d_r, d_n * reset])
            d_in[t] = np.concatenate([d_z, d_r, d_n])
            d_rec += g @ h.T
            back = d * z + m.recurrent[way].T @ g
        flat = d_in.transpose(1, 0, 2).reshape(3 * hidden, -1)
        grads[0].append(np.array([np.bincount(x.ravel(), row, minlength=256) for row in flat], np.float32))
        grads[1].append(d_rec)
        grads[2].append(d_out)
    return [*grads[0], *grads[1], *grads[2], p.sum(axis=(0, 2))]


def fit(docs: DataFrame, seed: int = 42, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Trains on at most sample_docs documents of each labelled language, those of least hash. Their whole texts are cut
    into windows of train_bytes; of these each language has its part of sample_windows, again those of least hash, so
    any place of a text can be learned from. All languages are learned. Documents that are held out or whose lang or
    text is null or empty aren't learned from; rows that repeat an id and language count once."""
    d = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    sizes = staged(d.groupBy("lang").count())
    n_langs = sizes.count()
    if not n_langs:
        return train([], [])
    key = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**30))
    # keys are even, so a threshold leaves about twice the wanted documents of each language for the exact choice
    below = sizes.select("lang", F.least(F.lit(2**30), F.ceil((2.0 * sample_docs + 50) / F.col("count") * 2**30)).alias("below"))
    below = F.broadcast(below) if n_langs <= BROADCAST_LANGS else below
    w = Window.partitionBy("lang").orderBy("key", "doc_id")
    few = d.select("doc_id", "lang", key.alias("key")).join(below, "lang").where(F.col("key") < F.col("below")).select("doc_id", "lang", "key").distinct()
    chosen = staged(few.withColumn("n", F.row_number().over(w)).where(F.col("n") <= sample_docs).select("doc_id", "lang"))
    of = F.broadcast(chosen) if n_langs * sample_docs <= 1_000_000 else chosen
    texts = d.join(of, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw, doc = b["text"][i].as_py().encode("utf-8", "surrogatepass"), b["doc_id"][i].as_py()
                for lo in range(0, len(raw), 65536 * train_bytes):
                    starts = range(lo, min(len(raw), lo + 65536 * train_bytes), train_bytes)
                    keys = [xxhash.xxh64_intdigest(f"{seed}:{doc}:{at}") >> 1 for at in starts]
                    yield pa.RecordBatch.from_arrays([pa.array([b["lang"][i].as_py()] * len(keys)), pa.array(keys, pa.int64()), pa.array([raw[at : at + train_bytes] for at in starts], pa.binary())], names=["lang", "key", "window"])

    each = max(WINDOWS_EACH, sample_windows // n_langs)
    first = Window.partitionBy("lang").orderBy("key", "window")
    rows = texts.mapInArrow(frugal(cut), "lang string, key long, window binary").withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).select("lang", "key", "window").collect()
    pairs = sorted((r["lang"], r["key"], bytes(r["window"])) for r in rows)
    return train([p[2] for p in pairs], [p[0] for p in pairs], seed=seed)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and n_bytes with share (of bytes labelled lang_pred) of each row, in any
    number of repeats, from the whole text. 'und' with score 0 where the text is null or has no letter, or no language
    was learned; equal probabilities go to the first name. Null ids are kept and not held out; other columns are
    ignored."""
    m = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            p, labels = document_probabilities(m, texts) if m.langs else (np.zeros((len(texts), 1)), np.zeros((len(texts), 1), np.int64))
            named = np.array([bool(m.langs) and any(map(str.isalpha, t or "")) for t in texts], bool)
            best = p.argmax(axis=1)
            at = np.arange(len(texts))
            size = labels.sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                b["doc_id"], pa.array([m.langs[i] if ok else "und" for i, ok in zip(best, named, strict=True)], pa.string()), pa.array(np.where(named, np.clip(p[at, best], 0, 1), 0.0)),
                pa.array(size), pa.array(np.where(named, labels[at, best] / np.maximum(1, size), 0.0)),
            ], names=["doc_id", "lang_pred", "score", "n_bytes", "share"])

    d = pick(docs, "doc_id", "text")
    out = d.mapInArrow(frugal(run), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_bytes long, share double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_bytes", "share")

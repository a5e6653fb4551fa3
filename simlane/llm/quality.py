"""Quality classifier: n-gram indicators scaled by class log-count ratios, a linear hinge-loss model fitted by dual
coordinate descent, and a logistic curve that turns its margins into scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import frugal, held_out, pick, slices, staged

#: Hashed features: one- and two-grams of words, and after them one- to three-grams of word shapes.
WORD_BITS, SHAPE_BITS = 18, 14
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Labelled documents that the model is fitted on at most, chosen by hash of their id, and their distinct features together.
SAMPLE_ROWS, SAMPLE_FEATURES = 6000, 30_000_000
#: Tokens handled at once, words remembered, and the longest that are.
CHUNK_TOKENS, KNOWN_WORDS, KNOWN_CHARS = 100_000, 100_000, 64
#: Characters of a text above which it is handled in slices.
LONG_CHARS = 2_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shape(word: str) -> str:
    """Runs of upper-case letters, lower-case letters and digits as A, a and 0, other characters once a run."""
    out, last = [], ""
    for c in word:
        k = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if k != last:
            out.append(k)
            last = k
    return "".join(out)


class _Words(dict):
    """word -> its hash in the upper and its shape's hash in the lower 32 bits."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = (xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass")) << 32) | xxhash.xxh32_intdigest(shape(word).encode("utf-8", "surrogatepass"))
        if len(word) <= KNOWN_CHARS:
            self[word] = value
        return value


def _mixed(a: np.ndarray, b: np.ndarray | int, kind: int) -> np.ndarray:
    h = (a + np.uint64(kind)) * _MIX[0]
    h ^= h >> np.uint64(29)
    h = (h + b) * _MIX[1]
    return h ^ (h >> np.uint64(32))


def _features(codes: np.ndarray, doc: np.ndarray, before: int | None = None) -> np.ndarray:
    """Distinct (doc << 20 | feature) of a run of tokens; n-grams don't cross documents. before: the code of the token
    before the first one, where the run goes on with its document."""
    if not len(codes):
        return np.zeros(0, np.uint64)
    words, shapes = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    same = doc[1:] == doc[:-1]
    again = np.r_[before is not None and int(codes[0]) == before, same & (codes[1:] == codes[:-1])]
    shapes = shapes * np.uint64(2) + again
    zero = np.uint64(0)
    w1, s1 = _mixed(words, zero, 1), _mixed(shapes, zero, 2)
    w2, s2 = _mixed(w1[:-1], words[1:], 3)[same], _mixed(s1[:-1], shapes[1:], 4)
    s3 = _mixed(s2[:-1], shapes[2:], 5)[same[:-1] & same[1:]] if len(codes) > 2 else s2[:0]
    s2 = s2[same]
    d = doc.astype(np.uint64) << np.uint64(20)
    d2, d3 = d[1:][same], d[2:][same[:-1] & same[1:]] if len(codes) > 2 else d[:0]
    wm, sm, base = np.uint64((1 << WORD_BITS) - 1), np.uint64((1 << SHAPE_BITS) - 1), np.uint64(1 << WORD_BITS)
    return np.unique(np.concatenate([d | (w1 & wm), d2 | (w2 & wm), d | (base + (s1 & sm)), d2 | (base + (s2 & sm)), d3 | (base + (s3 & sm))]))


def featurize(texts: Iterator[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(documents, their place in the run, feature) of runs of texts; a text's features are distinct and whole, also
    where it is longer than LONG_CHARS: its slices overlap by two tokens and are joined."""
    known = _Words()

    def run(tokens: list[list[str]], before: str | None = None) -> tuple[int, np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        codes = np.fromiter((known[w] for t in tokens for w in t), np.uint64, len(doc))
        keys = _features(codes, doc, None if before is None else known[before])
        return len(tokens), (keys >> np.uint64(20)).astype(np.int64), (keys & np.uint64(0xFFFFF)).astype(np.int64)

    held: list[list[str]] = []
    size = 0
    for text in texts:
        if len(text or "") > LONG_CHARS:
            if held:
                yield run(held)
                held, size = [], 0
            tail: list[str] = []
            before = None
            found = np.zeros(0, np.int64)
            for part in slices(text.encode("utf-8", "surrogatepass"), LONG_CHARS):
                words = tail + part.decode("utf-8", "surrogatepass").split()
                found = np.union1d(found, run([words], before)[2])
                before, tail = (words[-3] if len(words) > 2 else before), words[-2:]
            yield 1, np.zeros(len(found), np.int64), found
            continue
        words = (text or "").split()
        held.append(words)
        size += len(words)
        if size >= CHUNK_TOKENS:
            yield run(held)
            held, size = [], 0
    if held:
        yield run(held)


def _lengths(n: int, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """1 / norm of each entry's block: words and shapes of a document are scaled to length 1 apart."""
    block = 2 * doc + (feature >= 1 << WORD_BITS)
    return 1 / np.sqrt(np.maximum(1, np.bincount(block, minlength=2 * n)))[block]


@dataclass
class Model:
    """weights: r x w of each feature; score = 1 / (1 + exp(-(slope x margin + shift)))."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, n: int, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
        margin = self.bias + np.bincount(doc, self.weights[feature] * _lengths(n, doc, feature), minlength=n)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


@dataclass
class Rows:
    """Rows of distinct features, one after the other in one array; row i ends before starts[i + 1]. A row's values are
    ratio x the block's length, made when they are needed."""

    features: np.ndarray
    starts: np.ndarray
    ratio: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __post_init__(self):
        """Where each row's shapes begin; its features are sorted, so they follow its words."""
        words = np.r_[0, np.cumsum(self.features < 1 << WORD_BITS)]
        self.words = words[self.starts[1:]] - words[self.starts[:-1]]

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        f, cut = self.features[self.starts[i] : self.starts[i + 1]], self.words[i]
        v = self.ratio[f]
        v[:cut] /= np.sqrt(max(1, cut))
        v[cut:] /= np.sqrt(max(1, len(f) - cut))
        return f, v


def coordinate_descent(rows: Rows, own: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 12, seed: int = 42) -> tuple[np.ndarray, float]:
    """Weights and bias (a feature of value 1) of the linear model of least |w|^2 / 2 + sum(cost x hinge loss) over the
    rows `own`; y is +1 or -1. The dual variables stay in [0, cost] and are updated one at a time in a random order."""
    w, bias, a = np.zeros(len(rows.ratio)), 0.0, np.zeros(len(own))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(own)):
            f, v = rows.row(own[i])
            slope = y[i] * (w[f] @ v + bias) - 1
            new = min(max(a[i] - slope / (v @ v + 1), 0.0), cost[i])
            if new != a[i]:
                w[f] += (new - a[i]) * y[i] * v
                bias += (new - a[i]) * y[i]
                a[i] = new
    return w, bias


def _curve(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of greatest likelihood, with Platt's smoothed targets, by Newton steps."""
    n1, n0 = positive.sum(), (~positive).sum()
    t = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, b = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-3 * b)
        b = b + np.clip(step, -5, 5)
    return max(float(b[0]), 1e-3), float(b[1])


def fit_rows(features: np.ndarray, starts: np.ndarray, y: np.ndarray, alpha: float = 1.0, cost: float = 1.0) -> Model:
    """Model of labelled rows (see Rows): a fifth of them sets the curve, the others the weights. With one class alone
    the score is that class's smoothed share."""
    if len(y) < 2 or y.all() or not y.any():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    apart = np.arange(len(y)) % 5 == 4
    own = np.flatnonzero(~apart) if len(set(y[~apart])) == 2 and len(set(y[apart])) == 2 else np.arange(len(y))
    # the ratios are counted over the rows that set the weights, so the curve meets margins that haven't seen its labels
    counted = np.zeros(len(y), bool)
    counted[own] = True
    of, used = np.repeat(y, np.diff(starts)), np.repeat(counted, np.diff(starts))
    up, down = (alpha + np.bincount(features[used & side], minlength=FEATURES) for side in (of, ~of))
    rows = Rows(features, starts, np.log(up / up.sum()) - np.log(down / down.sum()))
    costs = cost * np.where(y, len(y) / (2 * y.sum()), len(y) / (2 * (~y).sum()))
    w, bias = coordinate_descent(rows, own, np.where(y[own], 1.0, -1.0), costs[own])
    rest = np.setdiff1d(np.arange(len(y)), own) if len(own) < len(y) else own
    margin = np.array([w[f] @ v + bias for f, v in (rows.row(i) for i in rest)])
    slope, shift = _curve(margin, y[rest])
    return Model(rows.ratio * w, bias, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES) -> Model:
    """Fitted on at most sample_rows labelled documents, those of least hash, without those held out; of these, in the
    same order, as many as have sample_features distinct features together (each has all of its own), so that neither
    many nor long documents exceed the driver's memory. Of several labels of a document the least counts, of several
    texts the first in order, so that repeated rows can't exceed the bound. Null labels and labels without a document
    count as none."""
    marked = pick(labels, "doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg((F.min("quality") >= 1).cast("int").alias("label"))
    chosen = marked.orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(sample_rows)
    texts = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for n, doc, feature in featurize(t.as_py() for t in b["text"]):
                cut = np.searchsorted(doc, np.arange(n + 1))
                found += [feature[s:e].astype(np.int32).tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]
            sizes = pa.array([len(x) // 4 for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), b["label"], sizes, pa.array(found, pa.binary())], names=["doc_id", "label", "n", "features"])

    made = staged(texts.mapInArrow(frugal(run), "doc_id long, label int, n long, features binary"))
    rows = sorted(((xxhash.xxh32_intdigest(str(r["doc_id"])), r["doc_id"], r["n"]) for r in made.select("doc_id", "n").collect()))
    fits = np.cumsum([r[2] for r in rows]) <= sample_features
    if not fits.all():
        last = rows[int(np.argmin(fits))][:2]
        kept = [r[1] for r in rows if r[:2] < last]
        made = made.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in kept], "doc_id long")), "doc_id", "left_semi")
    t = made.select("doc_id", "label", "features").toArrow()
    order = sorted(range(t.num_rows), key=lambda i: (xxhash.xxh32_intdigest(str(t["doc_id"][i])), t["doc_id"][i].as_py()))
    t = t.take(pa.array(order, pa.int64()))
    sizes = [len(x.as_buffer() or b"") // 4 for x in t["features"]]
    features = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in t["features"]] or [np.zeros(0, np.int32)])
    return fit_rows(features, np.r_[0, np.cumsum(sizes, dtype=np.int64)], np.array(t["label"].to_pylist(), bool))


def scored(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """The columns of docs (text among them or not) with quality_score, from the whole text; null counts as empty."""
    d = pick(docs, *dict.fromkeys([*columns, "text"]))
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", quality_score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.scores(*x) for x in featurize(t.as_py() for t in b["text"])]
            scores = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in columns], scores], names=[*columns, "quality_score"])

    return d.mapInArrow(frugal(run), schema)


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (the chance that label 1 is right) and predicted of each row, in any number of repeats.
    Null and empty texts have no features and get the score of the bias. Labels, lang, source and ids are no inputs;
    without labels all scores are 0.5. Null ids are kept and not held out; other columns are ignored."""
    s = scored(docs, fit(docs, labels, sample_rows), "doc_id")
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))

"""Language-model scores, languages and quality against plain versions, gradients and edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from simlane.llm import langid, lm_score, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "The cat sat on the mat", "en", "a", 22), (2, "the cat sat", "en", "a", 11), (2, "the cat sat", "en", "a", 11), (3, None, None, None, None),
    (4, "", "en", "a", 0), (5, " \n\t ", "en", None, 4), (None, "The dog", "en", "b", 7), (6, "the " * 500 + "end", "de", "b", 2003), (7, "1234 !!", "fr", "a", 7),
]


def table(spark, rows=ODD):
    """With extra columns, some of them named like results."""
    return spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("x"), "chunk": F.lit(1), "TEXT ": F.lit("y"), "held_out": F.lit(None).cast("string")})


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_backoff(texts, reference, order, alpha):
    every = [Counter(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)) for w in map(words, texts if reference is None else reference)]
    total = sum(every, Counter())
    n = sum(len(words(t)) for t in (texts if reference is None else reference))
    out = []
    for j, t in enumerate(texts):
        w = words(t)
        c = total - every[j] if reference is None else total
        size = max(1, n - (len(w) if reference is None else 0))
        s = 0.0
        for i in range(len(w)):
            x = math.log(max(c[(w[i],)], 0.5) / size)
            for k in range(2, min(order, i + 1) + 1):
                g = tuple(w[i - k + 1 : i + 1])
                x = math.log(c[g] / c[g[:-1]]) if c[g] > 0 else math.log(alpha) + x
            s += x
        out.append((len(w), s))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("other", [False, True])
def test_backoff(spark, order, other):
    reference = [(9, "the cat ran", "en", "a", 1), (9, "a dog sat on the mat", "en", "a", 1)] if other else None
    got = lm_score.scores(table(spark), table(spark, reference) if other else None, order, chunk_tokens=200, part_entries=50).collect()
    want = plain_backoff([r[1] for r in ODD], [r[1] for r in reference] if other else None, order, 0.4)
    assert sorted((str(r["doc_id"]), r["n_words"], round(r["log_score"], 8)) for r in got) == sorted((str(o[0]), n, round(s, 8)) for o, (n, s) in zip(ODD, want, strict=True))
    assert all((r["score"] is None) == (r["n_words"] == 0) for r in got)


def test_count_table(spark):
    """The table that the rows are joined to is the count of each n-gram; the join gives each row its entry."""
    pages = lm_score.paged(table(spark), 3, True)
    rows = lm_score.exploded(pages, 2, 6)
    total = {(r["part"], r["gram"]): r["total"] for r in lm_score.count_table(rows).collect()}
    every = Counter(g for _, t, *_ in ODD for w in [words(t)] for k in (1, 2) for g in (tuple(w[i : i + k]) for i in range(len(w) - k + 1)))
    assert sorted(total.values()) == sorted([*every.values(), sum(len(words(t)) for _, t, *_ in ODD)])
    own = {(r["chunk"], r["part"]): np.cumsum(lm_score._unpacked(r["grams"])).tolist() for r in rows.collect()}
    joined = {(r["chunk"], r["part"]): lm_score._unpacked(r["totals"]).tolist() for r in lm_score.with_totals(rows, True).collect()}
    assert own.keys() == joined.keys() and all([total[p, g] for g in own[c, p]] == t for (c, p), t in joined.items())


def test_layout_keeps_rows_in_proportion():
    for words in (10**3, 10**7, 10**9, 10**11, 3 * 10**13):
        chunks, bits = lm_score.layout(words, 3)
        assert words / chunks <= 12_000_001 and 3 * words / 2**bits <= 16_000_000 and chunks * 2**bits <= max(64 * chunks, 2 * words)


def test_repeated_rows_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PAGE_BYTES", 64)
    d = table(spark, [(1, "same row again", "en", "a", 1)] * 300)
    sizes = [r["count"] for r in lm_score.paged(d, 8, True).groupBy("chunk").count().collect()]
    assert len(sizes) == 8
    assert {round(r["score"], 6) for r in lm_score.scores(d, chunk_tokens=100).collect()} == {round(math.log(1 / 3) / 3, 6)}


def test_backoff_of_nothing(spark):
    assert lm_score.scores(table(spark, [])).count() == 0
    one = lm_score.scores(table(spark, [(1, "a b", None, None, None)])).first()
    assert one["n_words"] == 2 and math.isfinite(one["log_score"])


def test_slices_don_t_change_words(monkeypatch):
    text = "Alpha beta\tgamma " * 50 + "é" * 30 + " x"
    whole = lm_score.word_hashes(text, lm_score._Words())
    monkeypatch.setattr(lm_score, "SLICE", 7)
    assert (lm_score.word_hashes(text, lm_score._Words()) == whole).all() and len(whole) == 152


def test_recurrent_gradients():
    r = np.random.default_rng(0)
    m = langid.train([b"ab", b"cd"], ["x", "y"], steps=0, hidden=3)
    for group in (m.inputs, m.recurrent, m.output):
        for i, p in enumerate(group):
            group[i] = p.astype(np.float64)
    m.bias = r.normal(size=2)
    x = r.integers(0, 4, (5, 3)).astype(np.uint8)
    active, y = np.array([3, 3, 2, 2, 1]), np.array([0, 1, 1])

    def loss():
        p = langid.position_logits(m, x, active).astype(np.float64)
        p = p - np.log(np.exp(p).sum(axis=1, keepdims=True))
        return -sum(p[t, y[i], i] for t in range(5) for i in range(int(active[t]))) / active.sum()

    grads = langid._gradients(m, x, active, y)
    for p, g in zip([*m.inputs, *m.recurrent, *m.output, m.bias], grads, strict=True):
        for _ in range(6):
            at = tuple(r.integers(0, s) for s in p.shape) if p.shape != (9, 256) else (r.integers(0, 9), r.integers(0, 4))
            kept = p[at]
            ends = []
            for e in (1e-2, -1e-2):
                p[at] = kept + e
                ends.append(loss())
            p[at] = kept
            assert abs((ends[0] - ends[1]) / 2e-2 - g[at]) < 2e-3


def test_windows_label_every_byte():
    m = langid.train([b"aaaa bbbb", b"xxxx yyyy"] * 20, ["p", "q"] * 20, steps=40)
    p, labels = langid.document_probabilities(m, ["aaaa bbbb " * 100, "", None, "xxxx", "é"], window=64)
    assert labels.sum(axis=1).tolist() == [1000, 0, 0, 4, 2]
    assert abs(p[0].sum() - 1) < 1e-5 and p[1].sum() == 0 and p[0].argmax() == 0 and p[3].argmax() == 1
    q, _ = langid.document_probabilities(m, ["xxxx"], window=64)
    assert np.allclose(p[3], q[0], atol=1e-6)


def test_language_edges(spark):
    got = {(r["doc_id"], r["lang_pred"]): r for r in langid.identify(table(spark)).collect()}
    assert (3, "und") in got and (4, "und") in got and (5, "und") in got and (7, "und") in got
    assert all(0 <= r["score"] <= 1 for r in got.values()) and langid.identify(table(spark)).count() == len(ODD)
    assert langid.identify(table(spark, [])).count() == 0
    none = langid.identify(table(spark, [(1, "abc", None, None, None)])).first()
    assert (none["lang_pred"], none["score"]) == ("und", 0.0)


def test_language_accuracy_on_held_out(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 40 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97


def test_every_language_is_learned(spark):
    """Also the seventieth, and from any place of a text."""
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(70)]
    rows = [(1000 * k + i, (f"{w}{w} " * 30), f"l{k:02d}", "s", 1) for k, w in enumerate(words) for i in range(3)]
    assert len(langid.fit(spark.createDataFrame(rows, DOCS)).langs) >= 65
    late = [(i, "x " * 200 + ("der die das und " if i % 2 else "the and of was ") * 20, "de" if i % 2 else "en", "s", 1) for i in range(80)]
    m = langid.fit(spark.createDataFrame(late, DOCS))
    p, _ = langid.document_probabilities(m, ["der die das und " * 8, "the and of was " * 8])
    assert [m.langs[k] for k in p.argmax(axis=1)] == ["de", "en"]


def test_language_sample_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda windows, langs, **_: seen.append((len(windows), set(langs))))
    monkeypatch.setattr(langid, "WINDOWS_EACH", 1)
    rows = [(i, "word " * 500, ["a", "b", "c"][i % 3], "s", 1) for i in range(90)]
    langid.fit(spark.createDataFrame(rows, DOCS), sample_windows=30)
    langid.fit(spark.createDataFrame(rows, DOCS), sample_docs=1)
    assert seen[0] == (30, {"a", "b", "c"}) and seen[1][0] == 3 * -(-2500 // langid.TRAIN_BYTES)


def test_held_out_rows_are_not_learned_from(spark):
    from zlib import crc32

    rows = [(i, ("bonjour le monde " if crc32(str(i).encode()) % 3 == 1 else "hello the world ") * 3, "fr" if crc32(str(i).encode()) % 3 == 1 else "en", "s", 1) for i in range(60)]
    assert langid.fit(spark.createDataFrame(rows, DOCS)).langs == ["en"]


def test_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(1)
    x = r.normal(size=(40, 5))
    y = np.where(x[:, 0] + 0.3 * r.normal(size=40) > 0, 1.0, -1.0)
    rows = quality.Rows(np.tile(np.arange(5), 40), np.arange(0, 201, 5), np.ones(5))
    rows.row = lambda i: (np.arange(5), x[i])
    w = np.r_[quality.coordinate_descent(rows, np.arange(40), y, np.full(40, 1.0), rounds=300)]
    x1 = np.c_[x, np.ones(40)]
    value = lambda w: w @ w / 2 + np.maximum(0, 1 - y * (x1 @ w)).sum()
    assert all(value(w) <= value(w + 0.01 * r.normal(size=6)) + 1e-6 for _ in range(200))


@pytest.mark.parametrize("text", ["Word two, THREE!! two, " * 30, "a a a b b c " * 12, "x " * 200])
def test_features_are_whole_and_distinct(monkeypatch, text):
    (_, _, whole), = list(quality.featurize(iter([text])))
    monkeypatch.setattr(quality, "LONG_CHARS", 41)
    (_, _, cut), = list(quality.featurize(iter([text])))
    assert whole.tolist() == cut.tolist() == sorted(set(whole.tolist()))
    assert quality.shape("Ab12!!x") == "Aa0!a"


def test_shapes_are_of_whole_words():
    long = "a" * 90
    shapes = [next(quality.featurize(iter([w])))[2] for w in (long + "0", long + "!", long + "0")]
    assert quality.shape(long + "0!") == "a0!"
    assert shapes[0].tolist() == shapes[2].tolist() and set(shapes[0][shapes[0] >= 1 << quality.WORD_BITS]) != set(shapes[1][shapes[1] >= 1 << quality.WORD_BITS])


def test_sample_bound_of_features(spark, monkeypatch):
    seen = []
    fit_rows = quality.fit_rows
    monkeypatch.setattr(quality, "fit_rows", lambda f, starts, y: seen.append((len(f), len(y))) or fit_rows(f, starts, y))
    docs = spark.createDataFrame([(i, f"word{i} of {i % 2}", "en", "s", 1) for i in range(60)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    quality.fit(docs, labels)
    quality.fit(docs, labels, sample_features=100)
    quality.fit(docs, labels, sample_features=0)
    assert seen[0][1] > 30 and 0 < seen[1][1] < 15 and seen[1][0] <= 100 and seen[2] == (0, 0)


def test_ratios_have_not_seen_the_curve_s_rows():
    y = np.array([True, False] * 10)
    rows = [[1] if t else [2] for t in y]
    for i in range(4, 20, 5):
        rows[i] = [3]
    m = quality.fit_rows(np.concatenate(rows), np.arange(21), y)
    assert m.weights[1] != 0 and m.weights[2] != 0 and m.weights[3] == 0


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 0), (None, 1), (99, 1), (4, None)], "doc_id long, quality int").withColumn("toxic", F.lit(0))
    got = quality.classify(table(spark), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["score"] for r in quality.classify(table(spark), labels.where("false")).collect()} == {0.5}
    assert quality.classify(table(spark, []), labels).count() == 0


def test_quality_accuracy_on_held_out(spark, small):
    base = small.replace("sf0.001", "sf0.01")
    d, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = quality.classify(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["quality"] == r["predicted"] for r in got) / len(got) > 0.97

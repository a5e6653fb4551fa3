"""Vector search against brute force, and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from simlane.llm import ann_bits, blocks, exact_topk

SCHEMA = "vec_id long, embedding array<double>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"label": F.lit(1), "score": F.lit("x"), "page": F.lit(None).cast("string"), "VEC_ID ": F.lit(2)})


def brute(ids, v, own, k, whole=False):
    x = np.floor(1024 * v) if whole else v
    s = x @ x[list(ids).index(own)]
    order = np.lexsort((ids, -s))
    return [(int(ids[i]), float(s[i])) for i in order if ids[i] != own][:k]


def random_rows(n=400, d=20, seed=0, same=60):
    v = np.random.default_rng(seed).normal(size=(n, d))
    v[:same] = v[0]
    return list(range(n)), v


@pytest.mark.parametrize("page", [16, 4096])
def test_exact_top_k(spark, page):
    ids, v = random_rows()
    e = table(spark, [(i, x.tolist()) for i, x in zip(ids, v, strict=True)])
    got = exact_topk.top_k(e, e.where("vec_id % 50 = 0"), k=10, page_rows=page).collect()
    for q in range(0, 400, 50):
        own = sorted((r["rank"], r["vec_id"], float(r["score"])) for r in got if r["query_id"] == q)
        assert [(i, s) for _, i, s in own] == brute(ids, v, q, 10, True)


def test_large_components_stay_exact(spark):
    rows = [(1, [3e5, 1.0]), (2, [3e5, 1.0009765625]), (3, [2e5, -5.0])]
    got = exact_topk.top_k(table(spark, rows), table(spark, rows[:1]), k=5).collect()
    f = lambda x: [int(np.floor(1024 * c)) for c in x]
    want = {i: sum(a * b for a, b in zip(f(rows[0][1]), f(x), strict=True)) for i, x in rows[1:]}
    assert {r["vec_id"]: r["score"] for r in got} == want


def test_nearest_recall_and_scores(spark):
    ids, v = random_rows(1500, 64, 1, 0)
    e = table(spark, [(i, x.tolist()) for i, x in zip(ids, v, strict=True)])
    got = ann_bits.nearest(e, e.where("vec_id % 100 = 0"), k=20, page_rows=300).collect()
    hit = 0
    for q in range(0, 1500, 100):
        want = dict(brute(ids, v, q, 20))
        own = [r for r in got if r["query_id"] == q]
        assert sorted(r["rank"] for r in own) == list(range(1, 21))
        assert all(abs(r["score"] - v[q] @ v[r["vec_id"]]) < 1e-9 for r in own)
        hit += len(want.keys() & {r["vec_id"] for r in own})
    assert hit / 300 > 0.97


def test_error_bounds_hold():
    r = np.random.default_rng(2)
    v, q = r.normal(size=(500, 70)), r.normal(size=(9, 70))
    est, err = ann_bits.estimate(q, *ann_bits.decode(ann_bits.encode(v, 42), 500, 70), 42, 4.0)
    assert (np.abs(est - q @ v.T) <= err).mean() > 0.999
    assert np.allclose(ann_bits.rotation(64, 1) @ ann_bits.rotation(64, 1).T, np.eye(64))


NAN, INF = float("nan"), float("inf")
ODD = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [None, 1.0]), (8, [0.0, 0.0]), (9, [0.5, 0.5]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [-1.0, 0.0])]


def test_rows_that_take_no_part(spark):
    e = table(spark, ODD)
    near = ann_bits.nearest(e, e, k=20).collect()
    assert sorted({r["query_id"] for r in near}) == [1, 2, 9, 11]
    assert [(r["rank"], r["vec_id"]) for r in sorted(near, key=lambda r: r["rank"]) if r["query_id"] == 1] == [(1, 2), (2, 9), (3, 11)]
    exact = exact_topk.top_k(e, e, k=10).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(exact, key=lambda r: r["rank"]) if r["query_id"] == 1] == [(1, 2, 1 << 20), (2, 9, 1 << 19), (3, 8, 0), (4, 11, -(1 << 20))]


def test_no_rows(spark):
    e = table(spark, ODD[:0])
    assert ann_bits.nearest(e, e).count() == 0 and exact_topk.top_k(e, e).count() == 0
    one = table(spark, ODD[:1])
    assert ann_bits.nearest(one, one).count() == 0 and exact_topk.top_k(one, one).count() == 0


def test_odd_rows_equal_the_sql(spark, tmp_path):
    """Also rows that share an id."""
    import duckdb

    from simlane.llm import queries

    rows = [(i, [float(i % 7), -0.5 * i, 1.25]) for i in range(0, 400, 20)] + [(100, [9.0, 9.0, 9.0]), (120, [0.0, 0.0, -9.0]), *[r for r in ODD if len(r[1] or []) != 2], (300, [1.0, 2.0])]
    table(spark, rows).select("vec_id", "embedding").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.sql(queries.ORACLES["op5_pivot_distance"]).fetchall()
    got = queries.QUERIES["op5_pivot_distance"](spark, str(tmp_path)).collect()
    assert len(want) >= 30 and sorted(map(tuple, got)) == sorted(want)


def test_equal_vectors_go_by_id(spark):
    e = table(spark, [(i, [1.0, 1.0]) for i in range(100)])
    for f in (ann_bits.nearest, exact_topk.top_k):
        got = f(e, e.where("vec_id = 0"), k=5, page_rows=8).orderBy("rank").collect()
        assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("search", [ann_bits.nearest, exact_topk.top_k])
@pytest.mark.parametrize("known", [True, False])
def test_many_pages_and_blocks(spark, monkeypatch, search, known):
    """Queries in several blocks, and pages that are too many to tell every task about."""
    monkeypatch.setattr(blocks, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(blocks, "ROUTED", 2)
    if not known:
        monkeypatch.setattr(blocks, "ABOUT_BYTES", 10)
    ids, v = random_rows(300, 16, 5, 40)
    e = table(spark, [(i, x.tolist()) for i, x in zip(ids, v, strict=True)])
    got = search(e, e.where("vec_id % 30 = 0"), k=7, page_rows=24).collect()
    hit = 0
    for q in range(0, 300, 30):
        want = [i for i, _ in brute(ids, v, q, 7, search is exact_topk.top_k)]
        own = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        hit += len(set(want) & set(own))
        assert len(own) == 7 and (own == want or search is ann_bits.nearest)
    assert hit >= 68


@pytest.mark.parametrize("search", [ann_bits.nearest, exact_topk.top_k])
def test_queries_go_only_to_pages_that_can_answer(spark, monkeypatch, search):
    """Ten clusters far apart: a query meets the pages of its own and few others, and loses nothing."""
    r = np.random.default_rng(7)
    centre = r.normal(size=(10, 16)) * 10
    v = centre[np.arange(600) % 10] + r.normal(size=(600, 16)) * 0.3
    e = table(spark, [(i, x.tolist()) for i, x in enumerate(v)])
    monkeypatch.setattr(blocks, "ROUTED", 1)
    sent = spark.sparkContext.accumulator(0)
    matrices = blocks.matrices

    find = blocks.search

    def counted(data, asked, k, score, reach, one):
        def f(x, q):
            sent.add(len(q["ids"]))
            yield from one(x, q)

        return find(data, asked, k, score, reach, f)

    monkeypatch.setattr(blocks, "search", counted)
    assert matrices is blocks.matrices
    got = search(e, e.where("vec_id % 20 = 0"), k=5, page_rows=20).collect()
    for q in range(0, 600, 20):
        want = brute(list(range(600)), v, q, 5, search is exact_topk.top_k)
        assert [x["vec_id"] for x in sorted(got, key=lambda x: x["rank"]) if x["query_id"] == q] == [i for i, _ in want]
    assert sent.value < 30 * 30 / 2


@pytest.mark.parametrize("search", [ann_bits.nearest, exact_topk.top_k])
def test_pages_go_only_to_blocks_that_ask(spark, monkeypatch, search):
    """Clusters far apart, one block of queries or eight: pages aren't copied for blocks that don't need them."""
    r = np.random.default_rng(3)
    centre = r.normal(size=(16, 16)) * 20
    v = centre[np.arange(640) % 16] + r.normal(size=(640, 16)) * 0.1
    e = table(spark, [(i, x.tolist()) for i, x in enumerate(v)])
    find, met = blocks.search, {}
    for n in (1, 8):
        calls = spark.sparkContext.accumulator(0)

        def counted(data, asked, k, score, reach, one, calls=calls):
            def f(x, q):
                calls.add(1)
                yield from one(x, q)

            return find(data, asked, k, score, reach, f)

        monkeypatch.setattr(blocks, "search", counted)
        monkeypatch.setattr(blocks, "BLOCK_QUERIES", 64 // n)
        search(e, e.where("vec_id % 10 = 0"), k=5, page_rows=40).collect()
        met[n] = calls.value
    assert met[8] <= 1.2 * met[1]


def test_best():
    i, s = blocks.best(np.array([5, 3, 9, 1]), np.array([1.0, 2.0, 2.0, 0.0]), 3)
    assert i.tolist() == [3, 9, 5] and s.tolist() == [2, 2, 1]

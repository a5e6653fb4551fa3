"""Product codes against a plain search of all entries in Python's whole numbers."""

import hashlib
import random
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from simlane.llm import vector_codes as V

KIND = "vec_id long, embedding array<double>, label int"


def plain(rows, rounds=V.ROUNDS):
    """Of rows (vec_id, vector, label) of one dimension, a multiple of the parts."""
    kept = sorted(([i, [floor(4096 * x) for x in v], label] for i, v, label in rows if v is not None and all(x is not None and x == x and abs(x) != inf for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // 8
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:16]] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [(nearest(cut(v, p), book)[1], cut(v, p)) for _, v, _ in kept]
            for j in range(len(book)):
                if mine := [x for k, x in own if k == j]:
                    book[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(8)]
        out.append([i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), label, sha])
    return sorted((str((i, code, e, sum(x[2] for x in out if x[3] == label), sha)) for i, code, e, label, sha in out))


def coded(spark, rows, **more):
    return sorted(str(tuple(r)) for r in V.compressed(spark.createDataFrame(rows, KIND), **more).collect())


@pytest.mark.parametrize("seed", range(3))
def test_against_all_entries(spark, seed):
    rng = random.Random(seed)
    few = lambda: rng.choice((-1, 0, 1)) / 4096  # noqa: E731  so that ties abound
    rows = [(i, [few() if seed else rng.gauss(0, 1) for _ in range(16)], rng.choice((None, 1, 2))) for i in rng.sample(range(1000), 150)]
    rows += [(2000, None, 1), (2001, [1.0] * 15 + [None], 1), (2002, [nan] * 16, 1), (2003, [inf] * 16, None), rows[0], rows[0], (None, [0.25] * 16, None)]
    assert coded(spark, rows) == plain(rows)


def test_search_scans_no_more_than_it_needs():
    rng = np.random.default_rng(0)
    book = V.Codebook(rng.integers(-50, 50, (16, 4)))
    x = rng.integers(-60, 60, (500, 4))
    all_of = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    for start in (np.zeros(500, np.int64), all_of.argmin(axis=1), rng.integers(0, 16, 500)):
        best, d = book.search(x, start)
        assert (best == all_of.argmin(axis=1)).all() and (d == all_of.min(axis=1)).all()


def test_edges(spark):
    one = [(1, [0.5, -0.5] * 8, None)]
    assert coded(spark, one) == plain(one)
    assert coded(spark, []) == []
    assert coded(spark, [(1, [], 3)])[0].startswith("(1, '0000000000000000', 0, 0")
    short = coded(spark, [(i, [float(i)] * 3, 1) for i in range(40)])  # fewer components than parts
    assert len(short) == 40 and len({r.split("'")[3] for r in short}) == 1
    two = [(i, [float(i % 7)] * (8 + 8 * (i % 2)), 1) for i in range(60)]
    both = V.compressed(spark.createDataFrame(two, KIND)).collect()
    for d in (8, 16):
        own = [r for r in two if len(r[1]) == d]
        want = plain(own)
        assert sorted((r["vec_id"], r["code"], r["error"], r["codebooks_sha256"]) for r in both if r["vec_id"] % 2 == (d == 16)) == sorted((w[0], w[1], w[2], w[4]) for w in map(eval, want))
    with pytest.raises(ValueError):
        coded(spark, [(1, [1e30] * 8, 1)])


def test_extra_columns(spark):
    rows = [(i, [i / 7] * 8, i % 3) for i in range(30)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        f = spark.createDataFrame(rows, KIND).withColumns({"Label": F.lit("x"), "code": F.lit(1), "n": F.lit(2), "block": F.lit(3), "v": F.lit(4)})
        assert sorted(str(tuple(r)) for r in V.compressed(f).collect()) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_blocks_stay_where_they_are(spark):
    rows = V.whole(spark.createDataFrame([(i, [i / 7] * 8, i % 3) for i in range(30)], KIND))
    blocks = V.packed(rows)
    codes = spark.createDataFrame([], V.CODES)
    plan = V.met(blocks, codes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan

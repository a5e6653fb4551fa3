"""Periodic runs against a plain search over all periods and places."""

import hashlib
import random
import zlib

import pytest

from simlane.llm import periodic
from simlane.llm.queries import QUERIES


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            part = words[s : s + length]
            if length >= max(24, 3 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        a = (h // 10) % len(words)
        p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_small_alphabets(seed):
    rng = random.Random(seed)
    for _ in range(40):
        docs = []
        for d in range(rng.randrange(1, 5)):
            n = rng.randrange(0, 110)
            w = [b"abcdefghijklmnopqrstuvwxyz"[j : j + 1] for j in (rng.randrange(rng.choice((1, 2, 3, 20))) for _ in range(n))]
            if n > 30 and rng.random() < 0.6:
                p, s = rng.randrange(1, n // 3), rng.randrange(n // 2)
                w[s:] = (w[s : s + p] * n)[: n - s]
                if rng.random() < 0.5:
                    w[rng.randrange(n)] = b"z"
            docs.append((d, w))
        for (_, w), got in zip(docs, periodic.documents_runs(docs), strict=True):
            assert got == periodic.described(got[0], w, plain_runs(w))


def test_query_against_the_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {plain_row(r["doc_id"], (r["text"] or "").encode().split()) for r in docs if len(r["text"] or "") < 6000}
    got = {tuple(r) for r in QUERIES["op11_partition_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    assert want <= got
    assert sum(r[1] > 0 for r in got) >= len(docs) // 20


def test_batches_of_any_size_give_the_same_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [sorted(periodic.periodic_runs(d, True, n).collect()) for n in (1, 5000, 1 << 19)]
    assert rows[0] == rows[1] == rows[2]


def test_edges(spark):
    planted = next(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    long_text = "a b c " * 30000
    texts = [(1, None), (2, ""), (3, " \t\n\x0b"), (None, "x " * 30), (5, "x " * 23), (5, "x " * 23), (6, "x " * 24), (planted, "one two"), (8, long_text), (9, "x y z " * 24)]
    frame = spark.createDataFrame([(i, t, "t", 7) for i, t in texts], "doc_id long, text string, Text string, n_runs int")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        rows = sorted(periodic.periodic_runs(frame, True).collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    nothing = hashlib.sha256(b"").hexdigest()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i in (1, 2, 3):
        assert tuple(by[i]) == (i, 0, None, None, None, None, nothing, nothing)
    assert tuple(by[None])[1:6] == (1, 0, 30, 1, 30000)
    assert by[5]["n_runs"] == 0
    assert tuple(by[6])[1:6] == (1, 0, 24, 1, 24000)
    assert by[6]["collapsed_sha256"] == hashlib.sha256(b"x").hexdigest()
    assert by[planted]["n_runs"] == 0
    assert tuple(by[8])[1:5] == (1, 0, 90000, 3)
    assert by[9]["length"] == 24
    assert not periodic.periodic_runs(frame.where("false")).collect()

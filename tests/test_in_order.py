"""Sequences one by one: verdicts with a limit on candidates, batches of any size, common hashes and repeats."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F
from test_sequences import occurrences, plain_runs

from simlane.operators import dedup as D
from simlane.operators import sequences as S
from simlane.streaming import service


def plain(seqs, v, index=None):
    """vid -> (leader, candidate) one after the other, and the index in the end."""
    index, out = dict(index or {}), {}
    for q in sorted(seqs):
        x, best = seqs[q], None
        found = sorted((-sum(x.count(h) * y.count(h) for h in set(x)), c) for c, y in index.items() if set(x) & set(y) and c != q) if len(x) > 2 else []
        for _, c in found[: v.cand_limit]:
            y = index[c]
            r = plain_runs(x, y)[0]
            near = len(x) <= v.ratio * len(y) and len(y) <= v.ratio * len(x) if v.ratio else True
            t = (1.0 if len(x) <= 7 else 0.8) if v.rule == "both" else 0.6
            if near and r / len(x) >= t and (v.rule != "both" or r / len(y) >= t):
                best = c
                break
        out[q] = best is None, best
        if best is None and len(x) > 2 and q not in index:
            index[q] = x
    return out, index


def some_sequences(seed, n=40, letters="abcdefgh"):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))) for _ in range(5)]
    seqs = {}
    for i in range(n):
        s = list(rnd.choice(base) * rnd.choice((1, 1, 2)))
        if rnd.random() < 0.6:
            s[rnd.randrange(len(s))] = rnd.choice(letters)
        seqs[f"v{i:02}"] = "".join(s)[: rnd.choice((2, 9, 9, 18))]
    return seqs


@pytest.mark.parametrize(("seed", "variant"), [(1, D.V1), (2, D.V2), (3, D.SERVICE), (5, dataclasses.replace(D.SERVICE, cand_limit=2))])
def test_one_by_one(spark, seed, variant):
    seqs = some_sequences(seed)
    got = {r["vid"]: (r["leader"], r["similar_vid"]) for r in D.self_building(occurrences(spark, seqs), variant).collect()}
    assert got == plain(seqs, variant)[0]


@pytest.mark.parametrize("limit", [2, None])
def test_short_heads_wait_for_what_is_behind_them(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "HEADS", 2)
    v = dataclasses.replace(D.SERVICE, cand_limit=limit)
    seqs = some_sequences(7, 30, "abc")
    got = {r["vid"]: (r["leader"], r["similar_vid"]) for r in D.self_building(occurrences(spark, seqs), v).collect()}
    assert got == plain(seqs, v)[0]


def test_an_index_that_has_some_of_the_ids(spark):
    seqs = some_sequences(8)
    old = {k: s for k, s in some_sequences(9).items() if k < "v12" and len(s) > 2} | {"w1": "abcabc", "w2": seqs["v30"] + "x"}
    for v in (dataclasses.replace(D.SERVICE, cand_limit=2),):
        got = {r["vid"]: (r["is_unique"] == 1, r["similar_vid"]) for r in D.detect_in_order(occurrences(spark, seqs), occurrences(spark, old), v).collect()}
        assert got == plain(seqs, v, old)[0]
    got = D.detect_in_order(occurrences(spark, seqs), occurrences(spark, old), D.V2).where("code = 400").collect()
    assert {r["vid"] for r in got} == set(old) & set(seqs)


def test_nothing(spark):
    none = occurrences(spark, {"a": "abc"}).where("false")
    assert D.self_building(none, D.SERVICE).count() == 0
    assert [tuple(r) for r in D.self_building(occurrences(spark, {"a": "ab", "b": "ab"}), D.SERVICE).orderBy("vid").collect()] == [("a", True, None), ("b", True, None)]


@pytest.mark.parametrize("files", [3, 20])
def test_batches_of_any_size_give_the_same_rows(spark, tmp_path, files):
    seqs = {k: s for k, s in some_sequences(10).items() if k < "v12"}
    src = tmp_path / "in"
    src.mkdir()
    for i, (k, s) in enumerate(sorted(seqs.items())):
        (src / f"part-{i:02}.json").write_text("".join(f'{{"vid":"{k}","pos":{p},"hash":"{h}","ts":"2024-01-01T00:00:00Z"}}\n' for p, h in enumerate(s)))
    stream = spark.readStream.schema("vid string, pos int, hash string, ts timestamp").option("maxFilesPerTrigger", files).json(str(src))
    q = service.detect_stream(stream, str(tmp_path / "index"), str(tmp_path / "out"), D.SERVICE, str(tmp_path / "c"), F.lit("2024-02-01").cast("timestamp")).trigger(availableNow=True).start()
    assert q.awaitTermination(400)
    want, index = plain(seqs, D.SERVICE)
    assert {r["vid"]: (r["is_unique"] == 1, r["similar_vid"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
    assert {r["vid"] for r in service.read_index(spark, str(tmp_path / "index"), "vid string", 99).select("vid").distinct().collect()} == set(index)


def test_a_snapshot_leaves_out_what_is_too_old(spark, tmp_path):
    kind = "vid string, pos int, hash string, ts timestamp"
    days = {"a": "2023-07-05 00:00:00", "b": "2023-07-04 23:59:59", "c": "2023-12-31 00:00:00"}  # 180 days before the first of 2024
    for i, (v, t) in enumerate(days.items()):
        spark.createDataFrame([(v, 0, "x", t)], kind.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/batch={i}")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    service.compact(spark, str(tmp_path), kind, 2, F.timestamp_seconds(F.unix_timestamp(now) - 86400 * 180))
    left = service.read_index(spark, str(tmp_path), kind, 3)
    assert {r["vid"] for r in left.collect()} == {"a", "c"}
    assert left.collect() and D.fresh(left, now, 180).count() == 2


def joined_rows(df):
    """Rows that come out of the joins of the plan that ran."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        if "Join" in node.nodeName():
            m = node.metrics().get("numOutputRows")
            total += m.get().value() if m.isDefined() else 0
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_hash_that_all_have_is_not_joined(spark, monkeypatch):
    """The candidates' join grows in proportion although all sequences share a hash."""
    rows = {}
    for n in (100, 400):
        seqs = {f"v{i:03}": ["hot", *(f"{i // 2}.{j}" for j in range(5))] for i in range(n)}  # pairs of equal ones
        occ = spark.createDataFrame([(v, i, h) for v, s in seqs.items() for i, h in enumerate(s)], "vid string, pos int, hash string")
        bag, seen = S.bag(occ), []
        monkeypatch.setattr(D, "checkpointed", lambda d, seen=seen: (seen.append(joined_rows(d)), d)[1])
        pairs = D.near_pairs(bag, bag, D.V2)
        assert pairs.count() == n
        rows[n] = seen[0]
    assert rows[400] <= 4.5 * rows[100] < 400 * 400


def test_near_pairs_lose_nothing(spark):
    seqs = some_sequences(12, 50)
    occ = occurrences(spark, seqs)
    for v in (D.V1, D.V2):
        want = {(a, b) for a, x in seqs.items() for b, y in seqs.items() if a != b and D_passes(v, x, y)}
        assert {(r["q"], r["c"]) for r in D.passing_pairs(occ, occ, v).collect()} == want


def D_passes(v, x, y):  # noqa: N802
    if len(x) <= 2 or v.ratio and (len(x) > v.ratio * len(y) or len(y) > v.ratio * len(x)):
        return False
    r = plain_runs(x, y)[0]
    t = (1.0 if len(x) <= 7 else 0.8) if v.rule == "both" else 0.6
    return r / len(x) >= t and (v.rule != "both" or r / len(y) >= t)


def test_longest_prefixes():
    rnd = random.Random(0)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(0, 14))) for _ in range(2))
        want = [max((k for k in range(len(a) - i + 1) if a[i : i + k] in b), default=0) for i in range(len(a))]
        assert S.longest_prefixes(list(a), list(b)) == want


def test_sequences_that_repeat_themselves(spark):
    """Two alternating sequences of 20,000 places: their equality matrix has 200 million cells."""
    n = 20_000
    alt = spark.range(n).select(F.col("id").cast("int").alias("pos"), (F.col("id") % 2).cast("string").alias("hash"))
    occ = alt.withColumn("vid", F.lit("a")).unionByName(alt.where(F.col("pos") > 0).withColumn("vid", F.lit("b"))).select("vid", "pos", "hash")
    got = {(r["q"], r["c"]): (r["repeated"], r["period"]) for r in S.run_matches(occ, occ).collect()}
    assert got == {("a", "b"): (n - 1, 2), ("b", "a"): (n - 1, 1)}

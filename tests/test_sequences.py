import random

import pytest
from pyspark.sql import functions as F

from simlane.operators import dedup as D
from simlane.operators import sequences as S
from simlane.session import checkpointed

# Golden values: repeated and period of greedy run matching, one letter a hash.
RUNS = [
    ("abcd", "abcd", 4, 1), ("abcd", "xabcd", 4, 1), ("xabcd", "abcd", 4, 1), ("abXcd", "abYcd", 4, 2), ("abcd", "abdc", 3, 2), ("aaaa", "a", 2, 2),
    ("a", "aaaa", 1, 1), ("abcabc", "abc", 5, 2), ("abc", "abcabc", 3, 1), ("aXbcd", "abcd", 4, 2), ("abcd", "aXbcd", 3, 2), ("abcde", "abZcde", 4, 2), ("abZcde", "abcde", 5, 2),
]


def occurrences(spark, seqs, schema="vid string, pos int, hash string"):
    rows = [(v, i, h) for v, s in seqs.items() for i, h in enumerate(s)]
    return spark.createDataFrame(rows, schema)


def plain_runs(a, b):
    at = rep = per = 0
    while at < len(a):
        best = 0
        for j in range(len(b)):
            k = 0
            while at + k < len(a) and j + k < len(b) and a[at + k] == b[j + k]:
                k += 1
            best = max(best, k)
        rep, per, at = rep + best, per + (best > 0), at + best + 1
    return rep, per


def test_run_matching_golden(spark):
    q = occurrences(spark, {f"q{i}": a for i, (a, _, _, _) in enumerate(RUNS)})
    c = occurrences(spark, {f"c{i}": b for i, (_, b, _, _) in enumerate(RUNS)})
    pairs = spark.createDataFrame([(f"q{i}", f"c{i}") for i in range(len(RUNS))], "q string, c string")
    got = {r["q"]: (r["repeated"], r["period"]) for r in S.run_matches(q, c, pairs).collect()}
    assert got == {f"q{i}": (r, p) for i, (_, _, r, p) in enumerate(RUNS)}


def test_run_matching_and_bags_against_loops(spark):
    rnd = random.Random(3)
    seqs = {f"v{i:02}": "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12))) for i in range(18)}
    occ = occurrences(spark, seqs)
    runs = {(r["q"], r["c"]): (r["repeated"], r["period"]) for r in S.run_matches(occ, occ).collect()}
    bags = {(r["q"], r["c"]): r["matches"] for r in S.bag_matches(occ, occ).collect()}
    for a, x in seqs.items():
        for b, y in seqs.items():
            if a != b:
                assert runs.get((a, b), (0, 0)) == plain_runs(x, y)
                assert bags.get((a, b), 0) == sum(x.count(h) * y.count(h) for h in set(x))


def test_bag_counts_repeats(spark):
    q, c = occurrences(spark, {"q": "aab"}), occurrences(spark, {"c": "abb"})
    assert S.bag_matches(q, c).first()["matches"] == 4


def test_collapse(spark):
    got = S.collapse(occurrences(spark, {"v": "aabba", "w": ""})).orderBy("pos").collect()
    assert [(r["pos"], r["hash"]) for r in got] == [(0, "a"), (1, "b"), (2, "a")]


@pytest.mark.parametrize(("start", "want", "after", "wrapped"), [(3, [3, 4, 0, 1], 2, 1), (1, [1, 2, 3, 4], 0, 1), (0, [0, 1, 2, 3], 4, 0)])
def test_batch_slice(spark, start, want, after, wrapped):
    rows, next_start, epoch = S.batch_slice(spark.range(5), ["id"], start, 4)
    assert [r["id"] for r in rows.orderBy("slot").collect()] == want
    assert (next_start, epoch) == (after, wrapped)


def test_batch_slice_of_nothing(spark):
    rows, next_start, epoch = S.batch_slice(spark.range(0), ["id"], 0, 4)
    assert rows.count() == 0 and (next_start, epoch) == (0, 0)


@pytest.mark.parametrize("wide", [False, True])
def test_numbers_of_many_rows(spark, wide):
    """More rows than the sampler of ranges takes: each number from 0 occurs once, in the order."""
    n = 3_000_000 if not wide else 1_000_000
    d = spark.range(n, numPartitions=24).select(F.pmod(F.xxhash64("id"), F.lit(2**40)).alias("k"), "id", *([F.sha2(F.col("id").cast("string").cast("binary"), 512).alias("more")] if wide else []))
    rows, total = S.numbered_rows(d, ["k", "id"])
    got = rows.agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()
    assert total == n and tuple(got) == (n, n, 0, n - 1)
    some = rows.where("idx % 9973 = 0").orderBy("idx").collect()
    assert [(r["k"], r["id"]) for r in some] == sorted((r["k"], r["id"]) for r in some)


def test_cells_are_made_for_wanted_pairs_only(spark):
    occ = occurrences(spark, {f"v{i:02}": "abcd" for i in range(30)})
    pairs = spark.createDataFrame([("v00", "v01"), ("v02", "v02")], "q string, c string")
    runs = S.run_matches(occ, occ, pairs)
    assert [tuple(r) for r in runs.collect()] == [("v00", "v01", 4, 1)]
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LogicalRDD") > 0 and "LeftSemi" not in plan


def test_changes_of_a_long_video(spark):
    """A video of 300,000 frames beside one of none that counts: batches are gone through, no row holds a video."""
    n = 300_000
    frames = spark.range(n).select(F.lit("v").alias("vid"), F.col("id").alias("pos"), F.array((F.col("id") % 100).cast("double")).alias("feature"), F.col("id").cast("string").alias("hash"))
    none = spark.createDataFrame([("w", 0, [1.0], "x"), ("w", 1, None, None)], frames.schema)
    got = {r["vid"]: r["hashes"] for r in S.changes(frames.unionByName(none), 50.0, ["x"]).collect()}
    want, before, key = [], None, None
    for i in range(n):
        f = i % 100
        if (before is None or abs(f - before) > 50) and (key is None or abs(f - key) > 50):
            want.append(str(i))
            key = f
        before = f
    assert got == {"v": want, "w": []}


def test_changes_of_a_long_video_beside_null_features(spark):
    """As above, with columns that may be null: 300,000 frames of one video, and one of which no frame is given out."""
    n = 300_000
    frames = spark.range(n).select(F.lit("v").alias("vid"), F.col("id").alias("pos"), F.array((F.col("id") % 100).cast("double")).alias("feature"), F.col("id").cast("string").alias("hash"))
    none = spark.createDataFrame([("w", 0, [1.0], "x"), ("w", 1, None, None)], "vid string, pos long, feature array<double>, hash string")
    got = {r["vid"]: r["hashes"] for r in S.changes(frames.unionByName(none), 50.0, ["x"]).collect()}
    want, before, key = [], None, None
    for i in range(n):
        f = i % 100
        if (before is None or abs(f - before) > 50) and (key is None or abs(f - key) > 50):
            want.append(str(i))
            key = f
        before = f
    assert got == {"v": want, "w": []}


def test_changes_against_loop(spark):
    rnd = random.Random(5)
    data = {f"v{i}": [(rnd.choice([0.0, 4.0, 11.0, 30.0]), rnd.choice("abx")) for _ in range(15)] for i in range(6)}
    rows = [(v, i, [f], h) for v, s in data.items() for i, (f, h) in enumerate(s)]
    got = {r["vid"]: r["hashes"] for r in S.changes(spark.createDataFrame(rows, "vid string, pos int, feature array<double>, hash string"), 5.0, ["x"]).collect()}
    for v, s in data.items():
        before = key = None
        out = []
        for f, h in s:
            if (before is None or abs(f - before) > 5) and (key is None or abs(f - key) > 5) and h != "x":
                out.append(h)
                key = f
            before = f
        assert got[v] == out


def test_intro(spark):
    d = spark.createDataFrame([(list("abcd"),), (list("ab"),), (list("axcd"),), ([],)], "h array<string>")
    assert [r[0] for r in d.select(S.strip_intro(F.col("h"), ["a", "b"])).collect()] == [list("cd"), [], list("axcd"), []]


def test_sampling_without_rate(spark):
    assert S.sample(occurrences(spark, {"v": "abc"}), 0, 5).count() == 0


@pytest.mark.parametrize(
    ("variant", "rep", "nq", "nc", "want"),
    [(D.V1, 7, 7, 7, True), (D.V1, 6, 7, 7, False), (D.V1, 7, 8, 8, True), (D.V1, 6, 8, 8, False), (D.V2, 3, 5, 15, True), (D.SERVICE, 3, 5, 15, True), (D.V2, 2, 5, 5, False)],
)
def test_decision(spark, variant, rep, nq, nc, want):
    assert spark.range(1).select(D.passes(variant, F.lit(rep), F.lit(nq), F.lit(nc))).first()[0] is want


def test_length_ratio_and_short_sequences(spark):
    q = occurrences(spark, {"q5": "abcde", "q2": "ab"})
    for n, unique in ((15, 0), (16, 1)):
        c = occurrences(spark, {"c": "abc" + "xyzwvuts"[: min(8, n - 3)] + "mnopq"[: max(0, n - 11)]})
        assert D.lengths(c).first()["n"] == n
        got = {r["vid"]: r["is_unique"] for r in D.detect(q, c, D.V2).collect()}
        assert got == {"q5": unique, "q2": 1}
    assert {r["vid"] for r in D.indexable(q, D.detect(q, c, D.V2)).select("vid").distinct().collect()} == {"q5"}


def test_refusals_and_empty(spark):
    occ = occurrences(spark, {"a": "abcd", "b": "abcd"})
    asked = spark.createDataFrame([("a",), ("n",)], "vid string")
    got = {r["vid"]: (r["code"], r["msg"]) for r in D.detect(occ.where("vid = 'a'"), occ, D.V2, asked=asked).collect()}
    assert got == {"a": (400, "had detected"), "n": (400, "no hashes")}
    got = D.detect(occ.where("vid = 'a'"), occ, D.SERVICE).first()
    assert (got["code"], got["similar_vid"], got["rate"]) == (200, "b", 1.0)
    assert D.detect(occ.where("false"), occ, D.V1).count() == 0


def test_service_takes_ten_candidates_and_the_first_that_passes(spark):
    seqs = {f"c{i:02}": "abcde" + "vwxyz"[: i % 3] for i in range(14)} | {"zz": "abcde"}
    q = occurrences(spark, {"q": "abcde"})
    ranks = D.judged(q, occurrences(spark, seqs), D.SERVICE)
    assert ranks.count() == 10
    assert D.detect(q, occurrences(spark, seqs), D.SERVICE).first()["similar_vid"] == "c00"


def test_self_building_equals_one_by_one(spark):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 9))) for _ in range(6)]
    seqs = {}
    for i in range(30):
        s = list(rnd.choice(base))
        if rnd.random() < 0.6:
            s[rnd.randrange(len(s))] = rnd.choice("abcdefghij")
        seqs[f"v{i:02}"] = "".join(s)[: rnd.choice([2, 9, 9, 9])]
    got = {r["vid"]: (r["leader"], r["similar_vid"]) for r in D.self_building(occurrences(spark, seqs), D.V2).collect()}
    index = []
    for v in sorted(seqs):
        x, best = seqs[v], None
        cand = [(-sum(x.count(h) * seqs[c].count(h) for h in set(x)), c) for c in index]
        for m, c in sorted(cand):
            y = seqs[c]
            if len(x) > 2 and m < 0 and len(x) <= 3 * len(y) and len(y) <= 3 * len(x) and plain_runs(x, y)[0] / len(x) >= 0.6:
                best = c
                break
        assert got[v] == (best is None, best), v
        if best is None and len(x) > 2:
            index.append(v)


def test_age(spark):
    now = F.lit("2024-07-01 00:00:00").cast("timestamp")
    d = spark.createDataFrame([(0,), (1,)], "late int").select(F.timestamp_seconds(F.unix_timestamp(now) - 86400 * 180 - F.col("late")).alias("ts"), "late")
    assert [r["late"] for r in D.fresh(d, now, 180).collect()] == [0]

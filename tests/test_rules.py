from datetime import date

import pytest
from pyspark.sql import functions as F

from simlane.functions import scalars as X
from simlane.operators import geo, pairs, scoring, similarity, text

S4 = "0,0;4,0;4,4;0,4"
L6 = "0,0;4,0;4,2;2,2;2,4;0,4"
# Golden values: point, in the square, in the L.
POINTS = [((1, 1), True, True), ((0, 2), True, True), ((4, 2), False, False), ((2, 0), True, True), ((2, 4), False, False), ((3, 3), True, False), ((0, 0), True, True), ((4, 4), False, False)]


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("shift", [(0, 0), (100, -40)])
def test_ray_casting(spark, shift):
    dx, dy = shift
    move = lambda ring: ";".join(f"{float(p.split(',')[0]) + dx},{float(p.split(',')[1]) + dy}" for p in ring.split(";"))
    d = spark.createDataFrame([(float(x + dx), float(y + dy)) for (x, y), _, _ in POINTS], "x double, y double")
    got = d.select(*[geo.inside(geo.parse_ring(F.lit(move(r))), F.col("x"), F.col("y")) for r in (S4, L6)]).collect()
    assert [tuple(r) for r in got] == [(a, b) for _, a, b in POINTS]


def test_overlap_and_levels(spark):
    rings = spark.createDataFrame([("province", None, "P2", S4), ("province", None, "P1", S4), ("city", "P1", "C", "0,0;2,0;2,2;0,2"), ("city", "P2", "A", S4)], "level string, parent string, code string, line string")
    rings = rings.select("level", "parent", "code", geo.parse_ring(F.col("line")).alias("ring"))
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 9.0, 9.0), (4, None, 1.0)], "id int, x double, y double")
    got = {r["id"]: (r["code"], r["kind"]) for r in geo.locate(p, rings).collect()}
    assert got == {1: ("C", "city"), 2: ("P1", "province"), 3: (None, "none"), 4: (None, "none")}
    assert {r["kind"] for r in geo.locate(p, rings, ["P1"]).collect()} == {"district", "none"}


def test_cover_spares_tests_and_changes_nothing(spark):
    """Points in a wide polygon and in one with a bay, by the ray test and by cells; few points need the test."""
    rings = {"W": "-7,-3;90,-3;90,31;-7,31", "B": "0,0;40,0;40,40;20,5;0,40", "T": "3,3;4,3;3.5,4", "N": "1,1"}
    polygons = spark.createDataFrame(list(rings.items()), "code string, line string").select("code", geo.parse_ring(F.col("line")).alias("ring"))
    points = spark.range(4000).select("id", (F.col("id") % 80 * 1.25 - 8).alias("x"), (F.floor(F.col("id") / 80) * 0.9 - 5).alias("y"))
    want = points.crossJoin(polygons).where(geo.inside(F.col("ring"), F.col("x"), F.col("y"))).groupBy("id").agg(F.min("code").alias("code"))
    for step in (0.7, 2.5, 10.0, 1000.0):
        assert sorted(geo.containing(points, polygons, step=step).collect()) == sorted(want.collect())
    cells = geo.cover(polygons, 2.5)
    met = points.withColumns({"cx": F.floor(F.col("x") / 2.5), "cy": F.floor(F.col("y") / 2.5)}).join(cells, ["cx", "cy"])
    assert met.where("not whole").count() < met.where("whole").count() / 2


def test_grid(spark):
    got = geo.grid(spark, 12883, 12885, 4000, 4002).orderBy("id").collect()
    assert [(r["id"], r["x"], r["y"]) for r in got][0] == ("128834000", 128.83, 40.0)
    assert len(got) == 4 and geo.grid(spark, 1, 1, 0, 5).count() == 0


@pytest.mark.parametrize(("score", "service", "local"), [(0.81, "danger", "unsafe"), (0.80, "warning", "middle"), (0.51, "warning", "middle"), (0.50, "middle", "middle"), (0.20, "safe", "middle"), (0.19, "safe", "safe")])
def test_bands(spark, score, service, local):
    assert value(spark, scoring.band(F.lit(score))) == service
    assert value(spark, scoring.local_band(F.lit(score))) == local


def test_conclusion_counts_warnings_as_middle(spark):
    d = spark.createDataFrame([("v", 5, 0.9), ("v", 0, 0.85), ("v", 10, 0.6), ("v", 15, 0.3), ("v", 20, 0.1)], "video string, second int, score double")
    r = scoring.conclusions(d).first()
    assert (r["total_count"], r["danger_count"], r["warning_count"], r["middle_count"], r["safe_count"], r["danger_second"], r["warning_second"]) == (5, 2, 1, 2, 1, [0, 5], [10])


def test_thresholds_are_inclusive_and_let_nan_pass(spark):
    for metric, edge, out in (("cosine", 0.6, 0.5999), ("euclid", 3.0, 3.0001)):
        assert value(spark, similarity.keep_score(F.lit(edge), edge, metric)) is True
        assert value(spark, similarity.keep_score(F.lit(out), edge, metric)) is False
        assert value(spark, similarity.keep_score(F.lit(float("nan")), edge, metric)) is True


def test_cosine_of_zero(spark):
    zero, one = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(2.0))
    assert value(spark, similarity.cosine(zero, one)) == 0
    assert abs(value(spark, similarity.cosine(one, one)) - 1) < 1e-12


def test_recommend_ranks_and_limits(spark):
    docs = spark.createDataFrame([("d", [1.0, 0.0], ["long tag", "abc"])], "id string, vec array<double>, tags array<string>")
    rows = [(f"v{i:02}", [1.0, 0.0 if i < 41 else 5.0], ["long tag", "long tag"]) for i in range(43)] + [("short", [1.0, 0.0], ["abc"]), ("none", None, ["long tag"])]
    got = similarity.recommend(docs, spark.createDataFrame(rows, "id string, vec array<double>, tags array<string>")).orderBy("rank").collect()
    assert [r["video"] for r in got] == [f"v{i:02}" for i in range(40)]
    assert similarity.recommend(docs.where("false"), docs).count() == 0


def test_tags_by_bytes(spark):
    d = spark.createDataFrame([(1, ["abc", "abcd", "字", "字字", "", "abcd"])], "docid int, tags array<string>")
    assert sorted(r["tag"] for r in text.tag_index(d).collect()) == ["abcd", "字字"]


def test_records(spark):
    lines = spark.createDataFrame([('{"docid":"1","title":"t","dkeys":"a,,b ","x":1}',), ('{"docid":"2","title":"t"}',), ("no json",), (None,)], "value string")
    got = text.parse_records(lines).collect()
    assert [r["docid"] for r in got] == ["1"]
    assert value(spark, text.tags(F.lit("a,,b "))) == ["a", "", "b "]


def test_mean_vectors_keep_repeats(spark):
    t = spark.createDataFrame([("d", "x"), ("d", "x"), ("d", "y"), ("d", "the"), ("e", "unknown")], "id string, word string")
    voc = spark.createDataFrame([("x", [3.0, 0.0]), ("y", [0.0, 3.0]), ("the", [9.0, 9.0])], "word string, vec array<float>")
    got = text.mean_vectors(text.known_words(t, spark.createDataFrame([("the",)], "word string"), voc)).collect()
    assert [(r["id"], r["vec"]) for r in got] == [("d", [2.0, 1.0])]


def test_first_accepted_record(spark):
    d = spark.createDataFrame([("a", 2, None), ("a", 1, "v"), ("a", 0, "w")], "docid string, day int, vec string").where("vec is not null")
    assert text.first_records(d, "docid", [F.col("day").desc()]).first()["vec"] == "v"


def test_segment(spark):
    d = spark.createDataFrame([("abcd",), (None,)], "t string")
    assert [r["words"] for r in text.segment(d, "t", lambda s: [s[:2], s[2:]]).collect()] == [["ab", "cd"], None]


def test_days(spark):
    assert value(spark, X.trailing_days(F.lit(date(2024, 3, 10)), 7)) == ["20240309", "20240308", "20240307", "20240306", "20240305", "20240304"]
    assert value(spark, X.trailing_days(F.lit(date(2024, 3, 10)), 1)) == []


def test_names(spark):
    name = X.file_name(F.lit("http://h/p/clip.v2.mp4"))
    assert [value(spark, f) for f in (name, X.stem(name), X.extension(name), X.drop_last(F.lit("310000.txt")))] == ["clip.v2.mp4", "clip", "mp4", "310000"]


@pytest.mark.parametrize(("rate", "want"), [("30000/1001", 29), ("25", 25), ("25/0", None), ("23.98", None), ("x", None)])
def test_rates(spark, rate, want):
    assert value(spark, X.whole_rate(F.lit(rate))) == want


def test_pairs(spark):
    got = pairs.training_set(spark.range(5), "id", ["id"]).collect()
    assert sorted((r["left"], r["right"]) for r in got if r["label"] == [1, 0]) == [(i, i) for i in range(5)]
    assert all(r["left"] != r["right"] for r in got if r["label"] == [0, 1]) and len(got) == 10
    assert pairs.training_set(spark.range(1), "id", ["id"]).count() == 1


def test_form_and_scale(spark):
    assert value(spark, X.form_encoded("jsonResult", F.lit('{"a":1}'))) == "jsonResult=%7B%22a%22%3A1%7D"
    assert value(spark, pairs.scale(F.array(F.lit(255), F.lit(0)))) == [1.0, 0.0]

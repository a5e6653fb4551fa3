"""Segmentation of greatest probability against all segmentations of short texts."""

import math
import random
import re

from test_in_order import joined_rows

from simlane.operators import text

WORDS = "word string, weight long"


def plain(s, weights, total):
    """All ways through the word graph; the best score, ties to the longer word at the first difference."""
    cost = lambda w: round(math.log(w / total) * text.SCORE)

    def ways(at):
        if at == len(s):
            yield 0, (), []
            return
        run = re.match(r"(?s)[A-Za-z0-9]+|.", s[at:])[0]
        options = {(cost(weights[s[at:end]]), s[at:end]) for end in range(at + 1, len(s) + 1) if s[at:end] in weights} | {(cost(1), run)}
        for c, w in options:
            for more, lens, words in ways(at + len(w)):
                yield c + more, (len(w), *lens), [w, *words]

    return max(ways(0), key=lambda x: (x[0], x[1]))[2]


def test_against_all_ways(spark):
    rng = random.Random(5)
    weights = {"".join(rng.choice("北京大学生a") for _ in range(rng.randint(1, 4))): rng.randint(1, 60) for _ in range(25)}
    texts = ["".join(rng.choice("北京大学生a1 😀") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    got = text.best_words(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), spark.createDataFrame(list(weights.items()), WORDS))
    for r in got.collect():
        want = plain(texts[r["id"]], weights, sum(weights.values()))
        assert r["words"] == want


def test_a_reading_that_the_longest_match_misses(spark):
    weights = [("研究", 80), ("研究生", 20), ("生命", 90), ("命", 2), ("起源", 50)]
    t = spark.createDataFrame([(1, "研究生命起源")], "id long, text string")
    assert text.best_words(t, spark.createDataFrame(weights, WORDS)).first()["words"] == ["研究", "生命", "起源"]
    assert text.longest_match([w for w, _ in weights])("研究生命起源") == ["研究生", "命", "起源"]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "in 2024 北京"), (5, "x" * 300), (6, "北" * 3000), (7, "北京"), (8, "北京")]
    words = spark.createDataFrame([("北京", None), ("北京", 7), ("", 5), ("大学", -3)], WORDS)
    got = {r["id"]: r["words"] for r in text.best_words(spark.createDataFrame(rows, "id long, text string"), words).collect()}
    assert got[1] is None and got[2] == [] and got[3] == []
    assert got[4] == ["in", "2024", "北京"] and got[5] == ["x" * 300] and len(got[6]) == 3000 and got[7] == got[8] == ["北京"]
    nothing = text.best_words(spark.createDataFrame(rows, "id long, text string"), words.where("false"))
    assert {r["id"]: r["words"] for r in nothing.collect()}[4] == ["in", "2024", "北", "京"]
    assert text.best_words(spark.createDataFrame([], "id long, text string"), words).count() == 0


def test_no_row_for_each_substring(spark, monkeypatch):
    """every substring of a text was a row, joined to the dictionary; what is found in place is the same, also over pieces of a few
    characters, with words that hold white space, and texts that end in a word's beginning."""
    rng = random.Random(9)
    weights = {"".join(rng.choice("ab北1é") for _ in range(rng.randint(1, 6))): rng.randint(1, 50) for _ in range(40)} | {"a b": 900, "😀a": 3, "b\u0085": 2}
    texts = [None, "", " ", *("".join(rng.choice("ab北1é😀 \n\x0b\u0085-") for _ in range(rng.randint(0, 60))) for _ in range(80))]
    t, w = spark.createDataFrame(list(enumerate(texts)), "id long, text string"), spark.createDataFrame(list(weights.items()), WORDS)
    results = []
    for tree, piece in ((text.TREE, text.PIECE), (text.TREE, 25), (0, 25)):
        monkeypatch.setattr(text, "TREE", tree)
        monkeypatch.setattr(text, "PIECE", piece)
        found = text.best_words(t, w)
        results.append({r["id"]: r["words"] for r in found.collect()})
        assert (joined_rows(found) == 0) == (tree > 0)
    assert results[0] == results[1] == results[2] and len(results[0]) == len(texts)

"""Near copies against brute force over all pairs."""

import random
import re

import pytest

from simlane.llm import near_copies

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def least_ids(rows):
    """The least id of each group that chains of Jaccard 0.8 or more reach, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and (x == sets[j] or len(x & sets[j]) >= 0.8 * len(x | sets[j]) > 0):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(i, least.get(g, i))
    return sorted(least.values())


def changed(r, words, n):
    w = words[:]
    for at in r.sample(range(len(w)), n):
        w[at] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_stage_by_brute_force(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet").select(*p.COLUMNS)
    got = dict(p.STAGES)["near_duplicates"](spark, docs, small).collect()
    assert sorted(r["doc_id"] for r in got) == least_ids([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize(("part", "broadcast"), [(near_copies.PART_ROWS, 10), (7, 10), (7, near_copies.BROADCAST_SETS)])
def test_changed_words(spark, monkeypatch, part, broadcast):
    """Copies with a few changed words, also where a group is cut into parts; less alike ones stay."""
    monkeypatch.setattr(near_copies, "BROADCAST_SETS", broadcast)
    monkeypatch.setattr(near_copies.links, "__defaults__", (part,))
    r = random.Random(3)
    bases = [[f"w{r.randrange(500)}" for _ in range(200)] for _ in range(4)]
    texts = [changed(r, b, n) for b in bases for n in (0, 1, 2, 3, 4, 4, 5, 8, 12, 20, 40)] + ["A b  C", "a\tb c", "", " \n", None, "one two three four five"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    assert sorted(x["doc_id"] for x in near_copies.drop_near_copies(docs).collect()) == least_ids(rows)


def test_odd_rows(spark):
    rows = [(None, "alone in the world"), (1, "same text of six words here"), (1, "same text of six words here"), (1, "another one"), (2, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    kept = near_copies.drop_near_copies(docs).collect()
    assert sorted(str(x["text"]) for x in kept) == sorted(["alone in the world", "same text of six words here", "another one", "None"])
    assert near_copies.drop_near_copies(docs.where("false")).count() == 0

"""Quality rules against plain counts, and what they keep of labelled documents."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simlane.llm import divergence as D
from simlane.llm.queries import QUERIES


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def jsd(p, q):
    kl = lambda a, m: a * math.log2(a / m) if a else 0
    return math.sqrt(max(0, sum(kl(a, (a + b) / 2) + kl(b, (a + b) / 2) for a, b in zip(p, q, strict=True)) / 2))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"w": F.lit(1), "kept": F.lit("x"), "of": F.lit("en"), "Rest": F.lit(2)})


def test_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op12_divergence"](spark, small).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        n = plain_counts(d["text"])
        assert tuple(r)[1:6] == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_distances(spark, small):
    """References and distances in plain Python."""
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    words = {d["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "") for d in docs}
    refs = {}
    for lang in {d["lang"] for d in docs}:
        c = Counter(w for d in docs if d["lang"] == lang and len(words[d["doc_id"]]) >= 50 for w in words[d["doc_id"]])
        top = sorted(c, key=lambda w: (-c[w], w.encode()))[: D.COMMON]
        n = sum(c.values())
        refs[lang] = top, [c[w] / n for w in top] + [1 - sum(c[w] for w in top) / n]
    for r in QUERIES["op12_divergence"](spark, small).collect():
        d = next(x for x in docs if x["doc_id"] == r["doc_id"])
        w = words[r["doc_id"]]
        assert (r["word_distance"] is None) == (len(w) < D.MIN_WORDS)
        if len(w) >= D.MIN_WORDS:
            top, ref = refs[d["lang"]]
            own = Counter(w)
            p = [own[x] / len(w) for x in top]
            assert r["word_distance"] == pytest.approx(jsd([*p, 1 - sum(p)], ref), abs=2e-4)
        most = math.sqrt(D.FAR_WORDS**2 + D.BY_CHANCE / max(1, len(w)))
        far = (r["char_distance"] or 0) > D.FAR_CHARS or (r["word_distance"] or 0) > most
        if abs((r["word_distance"] or 0) - most) > 1e-3 and abs((r["char_distance"] or 0) - D.FAR_CHARS) > 1e-3:
            assert r["kept"] == (not r["base_failed"] and not far)


def test_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    r = QUERIES["op12_divergence"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    by = {(x["quality"], x["kept"]): x["count"] for x in r.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) == 0
    assert by[(0, False)] >= 9 * by.get((0, True), 0)


def test_edges(spark):
    prose = " ".join(f"{'the of and to in'.split()[i % 5]} w{i}" for i in range(60))
    rows = [(1, None, "en"), (2, "", None), (3, " \t\n\x0b\f\r", "en"), (4, "a b", "en"), (5, prose, "en"), (5, prose, "en"), (None, prose, None), (7, prose.upper() + "!", "en"), (8, prose * 500, "en"), (9, "É " * 80, "xx"), (10, "x\nx \nx\n\n\n", "en")]
    got = {(r["doc_id"], i): r for i, r in enumerate(D.judged(table(spark, rows)).orderBy("doc_id", "n_words").collect())}
    assert len(got) == len(rows)
    by = {k[0]: r for k, r in got.items()}
    for i in (1, 2, 3):
        assert tuple(by[i])[1:] == (0, 0, by[i]["n_symbols"], 0, 0, True, False, None, None)
    assert by[5]["kept"] and by[None]["kept"] and by[None]["word_distance"] is None
    assert not by[7]["kept"] and not by[7]["base_failed"]
    assert by[8]["base_failed"]
    assert by[9]["word_chars"] == 80 and by[9]["n_repeat_words"] == 80
    assert by[10]["n_dup_lines"] == 1
    assert D.judged(table(spark, [])).count() == 0
    short = D.judged(table(spark, [(1, "a b c", "en")])).collect()  # no document for a reference
    assert not short[0]["kept"]


def test_more_languages_than_are_broadcast(spark, monkeypatch, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    want = sorted(map(str, D.judged(d).collect()))
    monkeypatch.setattr(D, "BROADCAST_LANGUAGES", 0)
    assert sorted(map(str, D.judged(d).collect())) == want


def test_common_words_of_odd_form(spark):
    """Common words that mean something in a pattern, begin like one another or stand beside other white space than a blank."""
    common = ["a", "a.", ".a", "a|b", "\\E", "\\Qa", "\\1", "$1", "^", "[a-z]", "(?i)", "{2}", "*", "#", " ", "\u0085", "é", "é", "\U0001f600", "aa", "A", "\x01"]
    texts = [" ".join(common * 2), "\n".join(common) + "\ta", "a a  a\r\na\x0ba\x0ca", " a", "a ", "aaa xa ax a,", "b B . |", "", " a a\u0085", "  a a"]
    rows = spark.createDataFrame([(t, common) for t in texts], "text string, common array<string>").withColumn("n", F.size(F.array_remove(F.split("text", D.SPACE), "")).cast("long"))
    got = rows.select("text", D.common_counts(F.col("text"), F.col("n"), F.col("common"), D.any_of(F.col("common"))).alias("c")).collect()
    assert len(got) == len(texts)
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        assert r["c"] == [w.count(x) for x in common] + [sum(x not in common for x in w)], r["text"]


def test_text_is_searched_once_for_all_common_words(spark, small):
    """Where documents meet the references, words are not gone through for each common word."""
    plan = QUERIES["op12_divergence"](spark, small)._jdf.queryExecution().optimizedPlan()
    above = plan.toString().split("Join LeftOuter")[0]
    assert above.count("regexp_extract_all(text#") == 1 and not re.search(r"\bw#\d", above)


def test_no_python_on_the_main_path(spark, small):
    plan = QUERIES["op12_divergence"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

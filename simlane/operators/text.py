"""Titles and tags: parsing records, tokens, stop words, mean word vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simlane.session import checkpointed

#: Bytes of UTF-8 up to which a tag is not indexed.
SHORT_TAG = 3


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines -> (docid, title, dkeys): those with all three keys, extra keys ignored. An explicit null is taken as
    absent."""
    fields = [F.get_json_object(column, f"$.{k}").alias(k) for k in ("docid", "title", "dkeys")]
    others = [c for c in lines.columns if c != column]
    return lines.select(*others, *fields).where(F.col("docid").isNotNull() & F.col("title").isNotNull() & F.col("dkeys").isNotNull())


def tags(dkeys: Column) -> Column:
    """Comma-separated tags, untrimmed, empty ones kept."""
    return F.split(dkeys, ",")


def tag_index(df: DataFrame, id: str = "docid", column: str = "tags") -> DataFrame:
    """(tag, id), distinct, of tags longer than SHORT_TAG bytes."""
    return df.select(F.explode(column).alias("tag"), F.col(id).alias("id")).where(F.octet_length("tag") > SHORT_TAG).distinct()


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def segment(df: DataFrame, text: str, cut: Callable[[str], list[str]], out: str = "words") -> DataFrame:
    """Tokens by a given segmentation function, in Arrow batches; for languages that don't put spaces between words."""
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else list(cut(t)))

    return df.withColumn(out, run(text))


def longest_match(words: list[str]) -> Callable[[str], list[str]]:
    """A segmentation function from a dictionary's words, for segment(): at each place the longest word that is known,
    else a run of letters and digits beyond it, else one character; white space is left out. words must fit a worker."""
    known, longest = set(words), max(map(len, words), default=1)

    def cut(text: str) -> list[str]:
        out, at = [], 0
        while at < len(text):
            n = next((n for n in range(min(longest, len(text) - at), 0, -1) if text[at : at + n] in known), 0)
            if not n:
                n = 1
                while text[at].isascii() and text[at].isalnum() and at + n < len(text) and text[at + n].isascii() and text[at + n].isalnum():
                    n += 1
            if not text[at : at + n].isspace():
                out.append(text[at : at + n])
            at += n
        return out

    return cut


#: Scores are logarithms in millionths, whole numbers, so that ties are ties on any machine.
SCORE = 1_000_000


#: Characters of a dictionary up to which each task has it as a tree, and of texts that a task cuts in one go.
TREE, PIECE = 2_000_000, 200_000


def best_words(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """texts (id, text) to (id, words): the segmentation of greatest probability, the product of the words' shares of
    the dictionary's weights (word, weight; a missing weight counts 1).

    White space separates. In between, the words from a place on are those of the dictionary, and a run of ASCII letters and digits to its
    end, else one character, with a weight of 1; of ways as good that with the longer word comes first. A null text has null words; ids are
    those of one row each. A dictionary of up to TREE characters goes to all tasks, which find words and ways in place (WordTree); beyond that
    words are found by a join (joined_words), with the same results. A task holds the graph of a text, there of a stretch."""
    weights = dictionary.select("word", F.greatest(F.coalesce("weight", F.lit(1)), F.lit(1)).cast("long").alias("weight")).where("length(word) > 0").groupBy("word").agg(F.max("weight").alias("weight"))
    weights = checkpointed(weights)
    total, longest, characters = weights.agg(F.sum("weight"), F.max(F.length("word")), F.sum(F.length("word"))).first()
    total, longest = max(1, total or 1), longest or 1
    score = lambda w: F.round(F.log(w / F.lit(float(total))) * SCORE).cast("long")
    if (characters or 0) > TREE:
        return joined_words(texts, weights, longest, score)
    one = texts.sparkSession.range(1).select(score(F.lit(1.0))).first()[0]
    tree = WordTree([(r["word"], r["score"]) for r in weights.select("word", score(F.col("weight").cast("double")).alias("score")).collect()], one)
    held = texts.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(held.value.cut_all(b.column("text").to_pylist()), pa.list_(pa.string()))], names=["id", "words"])

    return texts.select("id", "text").repartition("id").mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, words array<string>")


class WordTree:
    """A dictionary as a tree of code points, and the best ways through texts; scores are whole numbers."""

    def __init__(self, words: list[tuple[str, int]], one: int):
        steps: dict[int, int] = {}
        ends: dict[int, int] = {}
        for word, score in words:
            at = 0
            for x in word:
                at = steps.setdefault(at << 21 | ord(x), len(steps) + 1)
            ends[at] = score
        self.one = one
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(steps.values(), np.int64, len(steps))[order]
        self.ends, self.scores = np.zeros(len(steps) + 1, bool), np.zeros(len(steps) + 1, np.int64)
        for at, score in ends.items():
            self.ends[at], self.scores[at] = True, score

    def found(self, points: np.ndarray, white: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, length and score of all words of the dictionary in a text, by place and length; none holds white space."""
        place = np.flatnonzero(~white) if len(self.keys) else np.zeros(0, np.int64)
        node, n, out = np.zeros(len(place), np.int64), 0, []
        while len(place):
            key = node << 21 | points[place + n]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            met = self.keys[at] == key
            place, node, n = place[met], self.to[at[met]], n + 1
            end = self.ends[node]
            out.append((place[end], np.full(int(end.sum()), n), self.scores[node[end]]))
            on = place + n < len(points)
            on[on] = ~white[place[on] + n]
            place, node = place[on], node[on]
        if not out:
            return place, place, place
        place, length, score = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(place, kind="stable")
        return place[order], length[order], score[order]

    def lengths(self, text: str) -> list[int]:
        """For each place the length of the word that is best from there on, 0 at white space."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        white = np.isin(points, [9, 10, 11, 12, 13, 32])
        place, length, score = self.found(points, white)
        begin, length, score = np.searchsorted(place, np.arange(len(points) + 1)).tolist(), length.tolist(), score.tolist()
        # runs of ASCII letters and digits end where the next other character is
        other = ~(((points >= 48) & (points <= 57)) | ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122)))
        here = np.arange(len(points))
        ends = np.minimum.accumulate(np.where(other, here, len(points))[::-1])[::-1]
        take = np.where(white, 0, np.where(other, 1, ends - here)).tolist()
        ahead = [0] * (len(points) + 1)
        for i in range(len(points) - 1, -1, -1):
            n = take[i]
            if n:
                best = self.one + ahead[i + n]
                for e in range(begin[i], begin[i + 1]):
                    s = score[e] + ahead[i + length[e]]
                    if s > best or s == best and length[e] > n:
                        best, n = s, length[e]
                ahead[i], take[i] = best, n
        return take

    def cut_all(self, texts: list[str | None]) -> list[list[str] | None]:
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < PIECE:
                size += len(texts[end] or "") + 1
                end += 1
            whole, begin = "\n".join(t or "" for t in texts[at:end]), 0
            take = self.lengths(whole)
            for t in texts[at:end]:
                words, i, last = [], begin, begin + len(t or "")
                while i < last:
                    if take[i]:
                        words.append(whole[i : i + take[i]])
                    i += take[i] or 1
                out.append(None if t is None else words)
                begin = last + 1
            at = end
        return out


def joined_words(texts: DataFrame, weights: DataFrame, longest: int, score: Callable[[Column], Column]) -> DataFrame:
    """best_words for any dictionary: the word graph is a join of substrings, no longer than the longest word, with the
    dictionary; the best way from each place to the end is a fold from the last place on."""
    stretches = texts.select("id", F.posexplode(F.split("text", r"\s+")).alias("part", "s")).where("s <> ''")
    place = stretches.select("id", "part", "s", F.explode(F.sequence(F.lit(1), F.length("s"))).alias("i"))
    window = place.select("id", "part", "i", F.expr(f"substring(s, i, {int(longest)})").alias("window"))
    found = window.select("id", "part", "i", "window", F.explode(F.sequence(F.lit(1), F.length("window"))).alias("len")).select("id", "part", "i", F.expr("substring(window, 1, len)").alias("word"))
    known = found.join(weights, "word").select("id", "part", "i", F.length("word").alias("len"), score(F.col("weight").cast("double")).alias("score"), "word")
    # where units begin: the lengths before them
    units = stretches.select("id", "part", F.regexp_extract_all("s", F.lit("(?s)([A-Za-z0-9]+|.)"), 1).alias("u"))
    begins = F.aggregate("u", F.array(F.lit(1)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x))))
    units = units.select("id", "part", F.explode(F.arrays_zip("u", begins.alias("at"))).alias("z")).where("z.u is not null")
    single = units.select("id", "part", F.col("z.u").alias("u"), F.col("z.at").alias("at"), F.explode(F.sequence(F.lit(0), F.length("z.u") - 1)).alias("j"))
    single = single.select("id", "part", (F.col("at") + F.col("j")).alias("i"), F.expr("substring(u, j + 1)").alias("word"))
    single = single.select("id", "part", "i", F.length("word").alias("len"), score(F.lit(1.0)).alias("score"), "word")
    edges = known.unionByName(single).groupBy("id", "part", "i").agg(F.collect_list(F.struct("score", "len", "word")).alias("edges"))
    graph = edges.groupBy("id", "part").agg(F.sort_array(F.collect_list(F.struct("i", "edges")), False).alias("g"))
    kind = "struct<ahead:array<bigint>,ways:array<struct<score:bigint,len:int,word:string>>>"

    def back(s: Column, x: Column, reach: Column) -> Column:
        # ahead: scores of the ways from the next places to the end, nearest first
        on = F.array_max(F.transform(x["edges"], lambda e: F.struct((e["score"] + F.coalesce(F.get(s["ahead"], e["len"] - 1), F.lit(0))).alias("score"), e["len"].alias("len"), e["word"].alias("word"))))
        both = F.transform(F.array(on), lambda b: F.struct(F.slice(F.concat(F.array(b["score"]), s["ahead"]), 1, reach).alias("ahead"), F.concat(s["ways"], F.array(b)).alias("ways")))
        return F.get(both, F.lit(0))

    # a unit may be longer than any word; an array of one stands for a name, so that its value is made once
    reach = F.greatest(F.lit(int(longest)), F.array_max(F.transform("g", lambda x: F.array_max(F.transform(x["edges"], lambda e: e["len"])))))
    start = F.struct(F.array().alias("ahead"), F.array().alias("ways")).cast(kind)
    ways = F.get(F.transform(F.array(reach), lambda r: F.aggregate("g", start, lambda s, x: back(s, x, r), lambda s: F.reverse(s["ways"]))), F.lit(0))
    walk = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast("array<string>").alias("words"))

    def forth(s: Column, w: Column) -> Column:
        here = s["at"] == s["i"]
        return F.struct(F.when(here, s["at"] + w["len"]).otherwise(s["at"]).alias("at"), (s["i"] + 1).alias("i"), F.when(here, F.concat(s["words"], F.array(w["word"]))).otherwise(s["words"]).alias("words"))

    cut = graph.select("id", "part", ways.alias("ways")).select("id", "part", F.aggregate("ways", walk, forth, lambda s: s["words"]).alias("words"))
    joined = cut.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("part", "words"))).alias("parts"))
    out = texts.select("id", F.col("text").isNull().alias("none")).join(joined, "id", "left")
    return out.select("id", F.when(~F.col("none"), F.coalesce(F.flatten(F.transform("parts", lambda p: p["words"])), F.array().cast("array<string>"))).alias("words"))


def known_words(tokens: DataFrame, stop: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Tokens (id, word) that are no stop words (word) and have a vector (word, vec); repeats stay."""
    return tokens.join(stop.select("word"), "word", "left_anti").join(vocabulary, "word")


def mean_vectors(tokens: DataFrame) -> DataFrame:
    """(id, vec) -> (id, vec): the mean of the vectors of each id's tokens, by place; ids without tokens have none. Vectors
    are summed whole, before the shuffle too: an id with many tokens sends one row a task."""
    mean = Summarizer.mean(array_to_vector(F.col("vec").cast("array<double>")))
    return tokens.where("vec is not null").groupBy("id").agg(mean.alias("m")).select("id", vector_to_array("m").alias("vec"))


def first_records(df: DataFrame, id: str, order: list[Column]) -> DataFrame:
    """The first row of each id in the order, taken after rows that don't count were filtered out."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(id).orderBy(*order))).where("_n = 1").drop("_n")


def nearest_one(queries: DataFrame, items: DataFrame, score: Callable[[Column, Column], Column], meets: Column | None = None) -> DataFrame:
    """The item of highest positive score for each query that shares a block key: queries (q, key, qv), items (c, key, cv);
    meets, if given, says which pairs count."""
    pairs = queries.join(items, "key")
    s = (pairs if meets is None else pairs.where(meets)).select("q", "c", score(F.col("qv"), F.col("cv")).alias("score")).where(F.col("score") > 0)
    return s.groupBy("q").agg(F.min_by(F.struct("c", "score"), F.struct((-F.col("score")).alias("s"), "c")).alias("b")).select("q", "b.c", "b.score")

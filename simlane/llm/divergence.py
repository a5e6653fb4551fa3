"""Quality rules by distribution divergence.

A language's reference is its distribution of characters over classes and of words over its most common ones and all
others, summed over the documents of the language. A document that is long enough is held against the reference of
its language by the Jensen-Shannon distance (the square root of the divergence to the base 2, from 0 to 1) of both histograms: prose
is near, text in capitals, sprinkled with symbols or without function words isn't. Fixed rules on length and repetition come first.

All of it is DataFrame functions: a document's counts are made in its row, references come from sums by language and word, of
which tasks send partial ones. Only the references meet the documents."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simlane.llm.common import pick, staged

#: White space between words, and characters that count as symbols.
SPACE, SYMBOLS = r"[\x20\x09-\x0D]+", "#*$%&|<>"
#: Character classes besides lower-case letters and, last, everything else in words.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "stop": r".,;:?'\x22()-"}
#: Words of a reference; words and characters below which a document isn't compared; largest distances of what is kept.
COMMON, MIN_WORDS, MIN_CHARS, FAR_WORDS, FAR_CHARS = 24, 50, 200, 0.4, 0.3
#: The divergence that a sample of n words of the reference itself has by chance is about BY_CHANCE / n bits: so much more is let pass.
BY_CHANCE = COMMON / (8 * math.log(2))
#: Languages up to which the references are broadcast (about 2 KB each).
BROADCAST_LANGUAGES = 4096
#: Base rules: fewest words, largest share of words in repeated windows in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text (null: empty), w (its words), n_words, word_chars, n_symbols, n_dup_lines and chars (sizes of the character
    classes) of each row. Whole texts are gone through for words and lines; classes and symbols are counted in what isn't a lower-case letter."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = pick(docs, "doc_id", "text", "lang").withColumn("text", F.coalesce("text", F.lit("")))
    base = base.select("doc_id", "lang", "text", F.array_remove(F.split("text", SPACE), "").alias("w"), lines.alias("lines"))
    base = base.withColumn("joined", F.array_join("w", ""))
    base = base.withColumn("rest", F.regexp_replace("joined", r"\p{Ll}+", ""))
    without = lambda c: (F.length("rest") - F.length(F.regexp_replace("rest", f"[{c}]+", ""))).cast("long")
    classes = [(F.length("joined") - F.length("rest")).cast("long"), *map(without, CLASSES.values())]
    base = base.select(
        "doc_id", "lang", "text", "w", F.size("w").cast("long").alias("n_words"), F.length("joined").cast("long").alias("word_chars"), without(re.escape(SYMBOLS)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.array(*classes).alias("chars"),
    )
    others = F.col("word_chars") - F.aggregate("chars", F.lit(0).cast("long"), lambda s, x: s + x)
    return base.withColumn("chars", F.concat("chars", F.array(others)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once, wherever Spark moves the expression and however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more. Windows are told by their hash (64 bits); unless all differ they are sorted
    by it, and equal neighbours give the places, of which each adds the words that the place behind it doesn't cover."""

    def windows(w: Column) -> Column:
        hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(hashed, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def repeats(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(ordered, lambda s: let(places(s), covered)))

    def places(s: Column) -> Column:
        same = lambda x, i: F.coalesce(x["h"] == F.get(s, i)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    return let(words, lambda w: let(windows(w), repeats))


def references(counts: DataFrame) -> DataFrame:
    """of (the language), common (its COMMON most frequent words; ties by word), words (shares of these and of the rest), chars
    (shares of the classes) and pattern (any_of the common words), from the counted documents that are long enough. The row of the
    null language has the characters of all documents and no words. A row has a bounded size."""
    k = len(CLASSES) + 2
    long = F.when(F.col("n_words") >= LEAST_WORDS, F.struct("w", "n_words", "chars"))  # no filter, which Spark would move below the counting and count twice for
    # of each document one row more, without a word, has its sums
    rows = counts.select("lang", long.alias("d")).select("lang", "d.n_words", "d.chars", F.explode_outer(F.array_append("d.w", F.lit(None).cast("string"))).alias("word"))
    own = lambda c: F.sum(F.when(F.col("word").isNull(), c))
    sums = rows.groupBy("lang", "word").agg(F.count("*").alias("times"), own(F.col("n_words")).alias("n"), *[own(F.col("chars")[i]).alias(f"c{i}") for i in range(k)])
    rank = F.row_number().over(Window.partitionBy("lang", F.col("word").isNull()).orderBy(F.col("times").desc(), "word"))  # limited in each task first
    best = staged(sums.withColumn("rank", rank).where(F.col("rank") <= COMMON))
    total = best.where("word is null and n is not null").select("lang", "n", *[f"c{i}" for i in range(k)])
    share = lambda parts, n: F.transform(parts, lambda x: x.cast("double") / n)
    every = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
    chars = share(F.array(*[f"c{i}" for i in range(k)]), every)
    top = best.where("word is not null and lang is not null").groupBy(F.col("lang").alias("of")).agg(F.sort_array(F.collect_list(F.struct("rank", "word", "times"))).alias("top"))
    named = top.join(total.where("lang is not null"), F.col("of") == F.col("lang"))
    times = F.transform("top", lambda x: x["times"])
    others = F.col("n") - F.aggregate(times, F.lit(0).cast("long"), lambda s, x: s + x)
    named = named.select("of", F.transform("top", lambda x: x["word"]).alias("common"), share(F.concat(times, F.array(others)), F.col("n")).alias("ref_words"), chars.alias("ref_chars"))
    pooled = total.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).where("c0 is not null")
    none = pooled.select(F.lit(None).cast("string").alias("of"), F.lit(None).cast("array<string>").alias("common"), F.lit(None).cast("array<double>").alias("ref_words"), chars.alias("ref_chars"))
    return named.unionByName(none).withColumn("pattern", any_of(F.col("common")))


def any_of(words: Column) -> Column:
    """A pattern whose first group is a whole word of a text that is one of these: ASCII punctuation is escaped, all else stands for itself."""
    escaped = F.transform(words, lambda x: F.regexp_replace(x, r"([!-/:-@\[-`{-~])", r"\\$1"))
    return F.concat(F.lit(r"(?:^|[\x20\x09-\x0D])("), F.array_join(escaped, "|"), F.lit(r")(?![^\x20\x09-\x0D])"))


def common_counts(text: Column, n_words: Column, common: Column, pattern: Column) -> Column:
    """How often each common word occurs, and how many words are left. One search of the text finds the common words (pattern is
    any_of them); of these each is taken out of what the ones before it left."""
    start = F.struct(F.regexp_extract_all(text, pattern, F.lit(1)).alias("rest"), F.array().cast("array<int>").alias("sizes"))

    def take(s: Column, word: Column) -> Column:
        return F.struct(F.array_remove(s["rest"], word).alias("rest"), F.concat(s["sizes"], F.array(F.size(s["rest"]))).alias("sizes"))

    left = F.aggregate(common, start, take, lambda s: s["sizes"])  # nothing is left of what was found
    sizes = lambda a: F.zip_with(a, F.slice(a, 2, F.size(a)), lambda x, y: x - F.coalesce(y, F.lit(0)))
    return let(left, lambda a: F.concat(sizes(a), F.array((n_words - F.get(a, F.lit(0))).cast("int"))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions over the same places."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def judged(documents: DataFrame, far_words: float = FAR_WORDS, far_chars: float = FAR_CHARS) -> DataFrame:
    """One row a row of documents (doc_id, text, lang): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, char_distance and word_distance (null where a document is too short for them or its language has no reference).

    Null and empty texts have no words and fail the base rules. Documents without a language are held against the characters
    of all; those of a language without a document of 50 words against nothing. Repeated rows are judged each, and count each in
    their reference; an empty table gives no rows; other columns are ignored. A window's hash has 64 bits."""
    counts = counted(documents)
    refs = staged(references(counts))
    refs = F.broadcast(refs) if refs.count() <= BROADCAST_LANGUAGES else refs
    met = counts.withColumn("n_repeat_words", repeat_words(F.col("w"))).drop("w").join(refs, F.col("lang").eqNullSafe(F.col("of")), "left")
    ratio = lambda a, n: F.transform(a, lambda x: x.cast("double") / n)
    met = met.withColumn("char_distance", F.when(F.col("word_chars") >= MIN_CHARS, distance(ratio("chars", F.col("word_chars")), F.col("ref_chars"))))
    met = met.withColumn("counts", F.when((F.col("n_words") >= MIN_WORDS) & F.col("common").isNotNull(), common_counts(F.col("text"), F.col("n_words"), F.col("common"), F.col("pattern"))))
    met = met.withColumn("word_distance", F.when(F.col("counts").isNotNull(), distance(ratio("counts", F.col("n_words")), F.col("ref_words"))))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    most = F.sqrt(far_words**2 + BY_CHANCE / F.col("n_words"))
    far = (F.coalesce("char_distance", F.lit(0.0)) > far_chars) | (F.col("word_distance").isNotNull() & (F.col("word_distance") > most))
    return met.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
        F.round("char_distance", 4).alias("char_distance"), F.round("word_distance", 4).alias("word_distance"),
    )


def oracle_sql() -> str:
    """The same rows in SQL, words, windows and lines as rows."""
    word = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    without = lambda c: f"length(rest) - length(regexp_replace(rest, '[{c.replace(chr(39), chr(39) * 2)}]+', '', 'g'))"
    k = len(CLASSES) + 2
    classes = ", ".join(["n_chars - length(rest)", *map(without, CLASSES.values())])
    term = "(CASE WHEN {a} > 0 THEN {a} * log2({a} / (({a} + {b}) / 2)) ELSE 0.0 END)"

    def distance(p: str, q: str) -> str:
        x, y = f"{p}[i]", f"{q}[i]"
        return f"sqrt(greatest(0.0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {term.format(a=x, b=y)} + {term.format(a=y, b=x)})) / 2))"

    return rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lang FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, lang, {word} AS w, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS joined,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
x AS MATERIALIZED (SELECT *, len(w) AS n_words, length(joined) AS n_chars, regexp_replace(joined, '\p{{Ll}}+', '', 'g') AS rest FROM w),
c AS MATERIALIZED (SELECT *, list_append(part, CAST(n_chars - list_sum(part) AS BIGINT)) AS chars FROM (SELECT *, [{classes}] AS part FROM x)),
win AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS i FROM x WHERE len(w) > 2)),
twice AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1)),
rep AS (SELECT r, CAST(sum(least(3, coalesce(j - i, 3))) AS BIGINT) AS n FROM twice GROUP BY r),
long AS (SELECT * FROM c WHERE n_words >= {LEAST_WORDS}),
total AS (SELECT lang, sum(n_words) AS n, [{", ".join(f"sum(chars[{i + 1}])" for i in range(k))}] AS s FROM long GROUP BY lang),
freq AS (SELECT lang, word, count(*) AS times FROM (SELECT lang, unnest(w) AS word FROM long WHERE lang IS NOT NULL) GROUP BY ALL),
top AS (SELECT lang, list(word ORDER BY rank) AS common, list(times ORDER BY rank) AS times FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY times DESC, word) AS rank FROM freq) WHERE rank <= {COMMON} GROUP BY lang),
ref AS MATERIALIZED (
  SELECT lang, common, list_transform(list_append(times, n - list_sum(times)), lambda x: CAST(x AS DOUBLE) / CAST(n AS DOUBLE)) AS ref_words, list_transform(s, lambda x: CAST(x AS DOUBLE) / CAST(list_sum(s) AS DOUBLE)) AS ref_chars FROM top JOIN total USING (lang)
  UNION ALL SELECT NULL, NULL, NULL, list_transform(s, lambda x: CAST(x AS DOUBLE) / CAST(list_sum(s) AS DOUBLE)) FROM (SELECT [{", ".join(f"sum(s[{i + 1}])" for i in range(k))}] AS s FROM total) WHERE s[1] IS NOT NULL),
hist AS (SELECT r, list_transform(common, lambda y: len(list_filter(w, lambda z: z = y))) AS got FROM c JOIN ref ON ref.lang = c.lang WHERE n_words >= {MIN_WORDS}),
far AS (SELECT c.r, CASE WHEN n_chars >= {MIN_CHARS} THEN {distance("list_transform(chars, lambda x: CAST(x AS DOUBLE) / n_chars)", "ref_chars")} END AS char_distance,
  CASE WHEN got IS NOT NULL THEN {distance("list_transform(list_append(got, n_words - list_sum(got)), lambda x: CAST(x AS DOUBLE) / n_words)", "ref_words")} END AS word_distance
  FROM c LEFT JOIN hist ON hist.r = c.r LEFT JOIN ref ON ref.lang IS NOT DISTINCT FROM c.lang)
SELECT doc_id, n_words, n_chars AS word_chars, {without(re.escape(SYMBOLS))} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * coalesce(rep.n, 0) > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * coalesce(rep.n, 0) > {MOST_REPEATED} * n_words) AND coalesce(char_distance, 0) <= {FAR_CHARS} AND (word_distance IS NULL OR word_distance <= sqrt({FAR_WORDS**2!r} + {BY_CHANCE!r} / n_words)) AS kept,
  round(char_distance, 4) AS char_distance, round(word_distance, 4) AS word_distance
FROM c LEFT JOIN rep ON rep.r = c.r LEFT JOIN far ON far.r = c.r"""

"""Tokens, title vectors, records, names, dates, stores and sink formats."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from simlane.functions import scalars as X
from simlane.operators import similarity, text
from simlane.plans.recommend_queries import _COS, _items, recommend_cosine
from simlane.plans.registry import ORACLES, query, table
from simlane.sources import files, keyed, sinks

_STOP = ("the", "of", "and", "to")
_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda w: w <> '')"
_TOKENS = f"""tok AS (SELECT conv_id * 1000 + turn AS id, unnest({_WORDS}) AS word FROM conversations),
voc AS (SELECT DISTINCT unnest({_WORDS}) AS word FROM benchmark)"""


def _tokens(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.explode(text.words(F.col("text"))).alias("word"))


def _vocabulary(spark, sf_dir):
    """Words of the benchmark with a vector of their length, first character and parity."""
    w = table(spark, sf_dir, "benchmark").select(F.explode(text.words(F.col("text"))).alias("word")).distinct()
    return w.select("word", F.array(F.length("word"), F.ascii("word"), F.length("word") % 2).cast("array<float>").alias("vec"))


def _stop(spark):
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{w}')" for w in _STOP) + " AS t(word)")


@query("known_words", f"WITH {_TOKENS} SELECT id, word, count(*) AS n FROM tok WHERE word NOT IN {_STOP} AND word IN (SELECT word FROM voc) GROUP BY ALL")
def known_words(spark, sf_dir):
    k = text.known_words(_tokens(spark, sf_dir), _stop(spark), _vocabulary(spark, sf_dir))
    return k.groupBy("id", "word").agg(F.count("*").alias("n"))


_SEGMENTED = """WITH RECURSIVE voc AS MATERIALIZED (SELECT word, count(*) AS weight FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY word),
t AS (SELECT sum(weight) AS total, max(length(word)) AS longest FROM voc),
parts AS (SELECT conv_id * 1000 + turn AS id, string_split_regex(replace(lower(text), ' ', ''), '\\s+') AS p FROM conversations WHERE text IS NOT NULL),
c AS MATERIALIZED (SELECT id, part, s, length(s) AS n FROM (SELECT id, unnest(p) AS s, generate_subscripts(p, 1) AS part FROM parts) WHERE s <> ''),
places AS (SELECT id, part, s, unnest(range(1, n + 1)) AS i FROM c),
subs AS (SELECT id, part, i, len, substr(s, i, len) AS word FROM (SELECT id, part, s, i, unnest(range(1, least(longest, length(s) - i + 1) + 1)) AS len FROM places, t)),
edges AS (SELECT id, part, i, len, CAST(round(ln(CAST(weight AS DOUBLE) / CAST(total AS DOUBLE)) * 1000000) AS BIGINT) AS score FROM subs JOIN voc USING (word), t
  UNION ALL SELECT id, part, i, length(regexp_extract(substr(s, i), '^([A-Za-z0-9]+|.)', 1)), CAST(round(ln(1.0 / CAST(total AS DOUBLE)) * 1000000) AS BIGINT) FROM places, t),
e AS MATERIALIZED (SELECT id, part, i, list({{'len': len, 'score': score}}) AS es FROM edges GROUP BY ALL),
back AS (SELECT id, part, n + 1 AS i, CAST([0] AS BIGINT[]) AS route, CAST([] AS BIGINT[]) AS lens FROM c
  UNION ALL SELECT id, part, i, list_prepend(b.score, route), list_prepend(b.len, lens) FROM (
    SELECT back.id, back.part, e.i, route, lens, list_max(list_transform(es, lambda x: {{'score': x.score + route[x.len], 'len': x.len}})) AS b FROM back JOIN e ON e.id = back.id AND e.part = back.part AND e.i = back.i - 1)),
ways AS MATERIALIZED (SELECT id, part, lens FROM back WHERE i = 1),
forth AS (SELECT id, part, 1 AS i, CAST([] AS VARCHAR[]) AS words FROM c
  UNION ALL SELECT f.id, f.part, f.i + w.lens[f.i], list_append(words, substr(c.s, f.i, w.lens[f.i])) FROM forth f JOIN ways w ON w.id = f.id AND w.part = f.part JOIN c ON c.id = f.id AND c.part = f.part WHERE f.i <= c.n),
done AS (SELECT id, string_agg(list_aggregate(words, 'string_agg', ' '), ' ' ORDER BY part) AS words FROM forth JOIN c USING (id, part) WHERE forth.i = c.n + 1 GROUP BY id)
SELECT conv_id * 1000 + turn AS id, CASE WHEN text IS NOT NULL THEN coalesce(words, '') END AS words FROM conversations LEFT JOIN done ON done.id = conv_id * 1000 + turn"""


@query("segmented_titles", _SEGMENTED.format(words=_WORDS))
def segmented_titles(spark, sf_dir):
    """Texts without blanks, cut into the words of the benchmark that are most probable together."""
    w = table(spark, sf_dir, "benchmark").select(F.explode(text.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("weight"))
    t = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.replace(F.lower("text"), F.lit(" "), F.lit("")).alias("text"))
    return text.best_words(t, w).select("id", F.array_join("words", " ").alias("words"))


@query("title_vectors", f"""WITH {_TOKENS} SELECT id, round(avg(CAST(length(word) AS DOUBLE)), 6) AS v0, round(avg(CAST(ascii(word) AS DOUBLE)), 6) AS v1, round(avg(CAST(length(word) % 2 AS DOUBLE)), 6) AS v2
FROM tok WHERE word NOT IN {_STOP} AND word IN (SELECT word FROM voc) GROUP BY id""")
def title_vectors(spark, sf_dir):
    m = text.mean_vectors(text.known_words(_tokens(spark, sf_dir), _stop(spark), _vocabulary(spark, sf_dir)))
    return m.select("id", *[F.round(F.col("vec")[i], 6).alias(f"v{i}") for i in range(3)])


@query("tag_index", "SELECT DISTINCT tag, conv_id AS id FROM (SELECT conv_id, unnest(string_split(text, ' ')) AS tag FROM conversations) WHERE octet_length(encode(tag)) > 3")
def tag_index(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").select("conv_id", F.split("text", " ").alias("tags"))
    return text.tag_index(t, "conv_id")


@query("tag_candidates", "SELECT DISTINCT a.vec_id AS q, b.vec_id AS c FROM embeddings a JOIN embeddings b ON a.label = b.label")
def tag_candidates(spark, sf_dir):
    t = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("tag"))
    return similarity.tag_candidates(t, t)


@query("nearest_one", f"""SELECT q, c, round(s, 6) AS score FROM (SELECT a.vec_id AS q, b.vec_id AS c, {_COS} AS s FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
WHERE s > 0 QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, c) = 1""")
def nearest_one(spark, sf_dir):
    """The nearest of every vector among all others of its label."""
    tags = F.array(F.concat(F.lit("label "), F.col("label").cast("string")))
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), tags.alias("tags"))
    # the least positive number: the score must be above 0
    best = similarity.recommend(e, e, "cosine", 5e-324, 1, same=False)
    return best.select(F.col("doc").alias("q"), F.col("video").alias("c"), F.round("score", 6).alias("score"))


@query("parse_records", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def parse_records(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.get_json_object("props", "$.k").alias("docid"), F.lit("t").alias("title"), F.lit("a,b").alias("dkeys"))).alias("value"))
    return text.parse_records(lines).select("event_id", F.col("docid").cast("long").alias("k"))


@query("record_tags", "SELECT page_id, unnest(string_split(url, ',')) AS tag FROM pages")
def record_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.tags(F.col("url"))).alias("tag"))


@query("url_names", """WITH n AS (SELECT page_id, string_split(url, '/')[-1] AS name FROM pages)
SELECT page_id, name, string_split(name, '.')[1] AS stem, string_split(name, '.')[-1] AS extension, CASE WHEN length(name) > 4 THEN left(name, length(name) - 4) ELSE '' END AS code FROM n""")
def url_names(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", X.file_name(F.col("url")).alias("name"))
    return p.select("page_id", "name", X.stem(F.col("name")).alias("stem"), X.extension(F.col("name")).alias("extension"), X.drop_last(F.col("name")).alias("code"))


@query("video_names", "SELECT page_id FROM pages WHERE lower(string_split(url, '.')[-1]) IN ('mp4', 'avi', 'mov', 'wmv', 'flv', 'mkv', 'mpg', 'rmvb') OR url LIKE '%page=2%'")
def video_names(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.where(files.has_extension(F.col("url")) | F.contains("url", F.lit("page=2"))).select("page_id")


@query("skipped_names", "SELECT page_id FROM pages WHERE page_id % 3 <> 0")
def skipped_names(spark, sf_dir):
    """Names of containers that aren't read (every third page's here) are passed over."""
    ending = F.when(F.col("page_id") % 3 == 0, ".rmvb").otherwise(".mp4")
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.col("page_id").cast("string"), ending).alias("name")).where(files.readable(F.col("name"))).select("page_id")


@query("dated_window", "SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-30' - 29 AND DATE '1996-06-30' - 1 GROUP BY 1")
def dated_window(spark, sf_dir):
    """Orders of the 29 days before a day: the window of 30 has one day less."""
    days = files.window_days(date(1996, 6, 30), 30)
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf_dir, "orders").select(day.alias("day")).where(F.col("day").isin(days)).groupBy("day").agg(F.count("*").alias("n"))


@query("trailing_days", "SELECT strftime(DATE '2024-03-10' - CAST(i AS INTEGER), '%Y%m%d') AS day FROM range(1, 7) t(i)")
def trailing_days(spark, sf_dir):
    return spark.range(1).select(F.explode(X.trailing_days(F.lit("2024-03-10").cast("date"), 7)).alias("day"))


@query("time_buckets", "SELECT CAST(floor(epoch(ts) / 100) * 100 AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1")
def time_buckets(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(X.time_bucket(F.col("ts")).alias("bucket")).agg(F.count("*").alias("n"))


@query("frame_rates", "SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(floor((l_partkey + 0.0) / (l_suppkey % 3)) AS BIGINT) END AS rate FROM lineitem")
def frame_rates(spark, sf_dir):
    r = F.concat_ws("/", F.col("l_partkey").cast("string"), (F.col("l_suppkey") % 3).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.whole_rate(r).alias("rate"))


@query("plain_tasks", "SELECT CAST(page_id AS VARCHAR) AS vid, 'none' AS title, url FROM pages WHERE page_id % 3 <> 0 AND url NOT LIKE '% %'")
def plain_tasks(spark, sf_dir):
    """Ids with a url become tasks; 'id none url' is dropped."""
    p = table(spark, sf_dir, "pages")
    lines = files.url_lines(p.select(F.col("page_id").alias("id")), p.where("page_id % 3 <> 0").select(F.col("page_id").alias("id"), "url"))
    return files.plain_tasks(lines)


@query("id_pairs", "SELECT unnest([l_partkey, l_suppkey]) AS id FROM lineitem")
def id_pairs(spark, sf_dir):
    """Both ids of every line."""
    return files.id_pairs(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("keyed_values", "SELECT CAST(page_id AS VARCHAR) AS id, url AS value FROM pages WHERE page_id % 2 = 0 AND page_id % 5 <> 0")
def keyed_values(spark, sf_dir):
    """A day's set of ids with the values they have; ids without one are left out."""
    p = table(spark, sf_dir, "pages")
    sets = p.where("page_id % 2 = 0").select(F.lit("fresh_video").alias("key"), F.lit("20240310").alias("day"), F.col("page_id").cast("string").alias("value"))
    items = p.where("page_id % 5 <> 0").select(F.concat(F.lit("item_"), F.col("page_id").cast("string")).alias("key"), F.lit(None).cast("string").alias("day"), F.col("url").alias("value"))
    landing = sets.unionByName(items)
    return keyed.values(landing, keyed.members(landing, "video", "20240310"))


@query("callback_bodies", """SELECT 'jsonResult=' || url_encode('{"doc_id":' || doc_id || ',"quality":' || quality || ',"toxic":' || toxic || '}') AS body FROM labels""")
def callback_bodies(spark, sf_dir):
    return sinks.callback_bodies(table(spark, sf_dir, "labels"))


_LINES = """SELECT CAST(doc AS VARCHAR) || chr(9) || string_agg(CAST(video AS VARCHAR) || chr(1) || CAST(rank AS VARCHAR), chr(2) ORDER BY rank) AS value FROM ({}) GROUP BY doc"""


@query("index_lines", _LINES.format(ORACLES["recommend_cosine"]))
def index_lines(spark, sf_dir):
    """Lines of the recommendation index; the rank stands in the score's place, which prints alike everywhere."""
    return sinks.index_lines(recommend_cosine(spark, sf_dir).withColumn("score", F.col("rank")))


@query("human_log", f"""WITH r AS ({ORACLES["recommend_cosine"]}) SELECT DISTINCT doc, 0 AS rank, CAST(doc AS VARCHAR) AS value FROM r
UNION ALL SELECT doc, rank, '----------' || video || ' ' || rank || ' t' || video FROM r""")
def human_log(spark, sf_dir):
    titles = _items(spark, sf_dir).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"))
    return sinks.human_log(recommend_cosine(spark, sf_dir).withColumn("score", F.col("rank")), titles)


@query("request_check", "SELECT event_id, props IS NOT NULL AND props <> '' AND event_type <> 'view' AS ok FROM events")
def request_check(spark, sf_dir):
    """Requests with a field missing go to the error side."""
    from simlane.streaming.service import checked

    e = table(spark, sf_dir, "events").withColumn("event_type", F.when(F.col("event_type") != "view", F.col("event_type")))
    good, bad = checked(e, ["props", "event_type"])
    return good.select("event_id", F.lit(True).alias("ok")).unionByName(bad.select("event_id", F.lit(False).alias("ok")))


@query("answered_requests", """SELECT event_id AS vid, CASE WHEN event_id % 2 = 0 AND age <= 360 THEN true END AS has_same_video, CAST(CASE WHEN event_id % 2 = 0 AND age <= 360 THEN event_id END AS VARCHAR) AS same_video,
  CASE WHEN event_id % 2 = 0 AND age <= 360 THEN 0 WHEN age > 300 THEN 1 END AS err_code, CASE WHEN event_id % 2 = 0 AND age <= 360 OR age > 300 THEN 'done' ELSE 'waiting' END AS state
FROM (SELECT event_id, event_id % 500 AS age FROM events)""")
def answered_requests(spark, sf_dir):
    """Requests answered, waiting or given up; results expire."""
    from simlane.streaming.service import answered

    e = table(spark, sf_dir, "events")
    now = F.lit("2024-03-10 12:00:00").cast("timestamp")
    at = F.timestamp_seconds(F.unix_timestamp(now) - F.col("event_id") % 500)
    requests = e.select(F.col("event_id").alias("vid"), at.alias("asked_at"))
    results = e.where("event_id % 2 = 0").select(F.col("event_id").alias("vid"), F.lit(True).alias("has_same_video"), F.col("event_id").cast("string").alias("same_video"), F.lit(0).alias("err_code"), at.alias("done_at"))
    return answered(requests, results, now)

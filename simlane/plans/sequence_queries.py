"""Near-duplicate queries: a document is a sequence, a line's hash the first four digits of its MD5. Matches are between
all documents; detection has two tables, as an id that is indexed is refused: documents of even id are the index, those
of odd id come in."""

from __future__ import annotations

from pyspark.sql import functions as F

from simlane.operators import dedup as D
from simlane.operators import sequences as S
from simlane.plans.registry import query, table
from simlane.session import checkpointed
from simlane.sources import sinks


def line_hashes(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vid"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.trim("line") != "").select("vid", "pos", F.substring(F.md5(F.trim("line").cast("binary")), 1, 4).alias("hash"))


def sequences(spark, sf_dir):
    return S.collapse(line_hashes(spark, sf_dir))


def sides(spark, sf_dir):
    """Queries and index. Detection reads each side several times (bags, lengths, cells), so the sequences, a few bytes a
    line, are written once instead of cutting and hashing all texts again for each."""
    occ = checkpointed(sequences(spark, sf_dir))
    return occ.where(F.col("vid") % 2 == 1), occ.where(F.col("vid") % 2 == 0)


OCC = """l AS (SELECT doc_id AS vid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
f AS (SELECT vid, i, substr(md5(trim(line)), 1, 4) AS hash FROM l WHERE trim(line) <> ''),
g AS (SELECT *, lag(hash) OVER (PARTITION BY vid ORDER BY i) AS b FROM f),
occ AS (SELECT vid, CAST(row_number() OVER (PARTITION BY vid ORDER BY i) - 1 AS INTEGER) AS pos, hash FROM g WHERE b IS NULL OR b <> hash),
nn AS (SELECT vid, count(*) AS n FROM occ GROUP BY vid),
qo AS (SELECT * FROM occ WHERE vid % 2 = 1)"""
BAGS = """bags AS (SELECT q, c, CAST(sum(nq * nc) AS BIGINT) AS matches FROM (SELECT vid AS q, hash, count(*) AS nq FROM qo GROUP BY ALL) JOIN (SELECT vid AS c, hash, count(*) AS nc FROM io GROUP BY ALL) USING (hash) GROUP BY q, c)"""
WALK = """cells AS (SELECT p.q, p.c, a.pos AS i, a.pos - b.pos AS d FROM pairs p JOIN occ a ON a.vid = p.q JOIN occ b ON b.vid = p.c AND b.hash = a.hash),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY q, c, d ORDER BY i) AS g FROM cells),
ends AS (SELECT q, c, i, max(i) OVER (PARTITION BY q, c, d, g) - i + 1 AS run FROM islands),
longest AS (SELECT q, c, i, max(run) AS run FROM ends GROUP BY q, c, i),
walk AS (SELECT q, c, nq, CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS rep, CAST(0 AS BIGINT) AS per FROM pairs
  UNION ALL SELECT w.q, w.c, w.nq, w.pos + coalesce(r.run, 0) + 1, w.rep + coalesce(r.run, 0), w.per + CASE WHEN r.run > 0 THEN 1 ELSE 0 END
  FROM walk w LEFT JOIN longest r ON r.q = w.q AND r.c = w.c AND r.i = w.pos WHERE w.pos < w.nq),
done AS (SELECT q, c, max(rep) AS repeated, max(per) AS period FROM walk GROUP BY q, c)"""


def _pairs(v: D.Variant) -> str:
    ratio = f" AND b.n <= {v.ratio} * a.n AND a.n <= {v.ratio} * b.n" if v.ratio else ""
    limit = f" QUALIFY row_number() OVER (PARTITION BY q ORDER BY matches DESC, c) <= {v.cand_limit}" if v.cand_limit else ""
    return f"""top AS (SELECT q, c, matches FROM bags JOIN nn ON nn.vid = bags.q WHERE nn.n > 2{limit}),
pairs AS (SELECT q, c, matches, a.n AS nq, b.n AS nc FROM top JOIN nn a ON a.vid = top.q JOIN (SELECT vid, count(*) AS n FROM io GROUP BY vid) b ON b.vid = top.c WHERE true{ratio})"""


def _detect_sql(v: D.Variant, age: str = "") -> str:
    t = "repeated / nq >= (CASE WHEN nq <= 7 THEN 1.0 ELSE 0.8 END) AND repeated / nc >= (CASE WHEN nq <= 7 THEN 1.0 ELSE 0.8 END)" if v.rule == "both" else "repeated / nq >= 0.6"
    return f"""WITH RECURSIVE {OCC},
io AS (SELECT * FROM occ WHERE vid % 2 = 0{age}), {BAGS}, {_pairs(v)}, {WALK},
hit AS (SELECT q, c, repeated / nq AS rate FROM pairs JOIN done USING (q, c) WHERE {t} QUALIFY row_number() OVER (PARTITION BY q ORDER BY matches DESC, c) = 1)
SELECT n.vid, 200 AS code, CASE WHEN hit.q IS NULL THEN 1 ELSE 0 END AS is_unique, hit.c AS similar_vid, round(hit.rate, 6) AS rate,
  CASE WHEN hit.q IS NULL THEN 'unique' ELSE 'repetitive' END AS msg
FROM (SELECT DISTINCT vid FROM qo) n LEFT JOIN hit ON hit.q = n.vid"""


def _detect(spark, sf_dir, v):
    q, items = sides(spark, sf_dir)
    now = None
    if v.max_age_days is not None:
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        items = items.withColumn("ts", F.timestamp_seconds(F.unix_timestamp(start) + F.col("vid") * 3600))
        now = F.timestamp_seconds(F.unix_timestamp(start) + 4700 * 3600)
    return D.detect(q, items, v, now).withColumn("rate", F.round("rate", 6))


@query("collapse_sequences", f"WITH {OCC} SELECT vid, pos, hash FROM occ")
def collapse_sequences(spark, sf_dir):
    return sequences(spark, sf_dir).select("vid", "pos", "hash")


_ALL = OCC.replace(" WHERE vid % 2 = 1", "")


@query("bag_matches", f"WITH {_ALL}, io AS (SELECT * FROM occ), {BAGS} SELECT q, c, matches FROM bags WHERE q <> c")
def bag_matches(spark, sf_dir):
    occ = checkpointed(sequences(spark, sf_dir))
    return S.bag_matches(occ, occ)


@query("run_matches", f"""WITH RECURSIVE {_ALL}, io AS (SELECT * FROM occ), {BAGS.replace("USING (hash) GROUP", "USING (hash) WHERE q <> c GROUP")}, {_pairs(D.V2)}, {WALK}
SELECT q, c, repeated, period FROM done""")
def run_matches(spark, sf_dir):
    occ = checkpointed(sequences(spark, sf_dir))
    return D.all_runs(occ, occ, D.V2, ("repeated", "period"))


@query("detect_v1", _detect_sql(D.V1))
def detect_v1(spark, sf_dir):
    return _detect(spark, sf_dir, D.V1)


@query("detect_v2", _detect_sql(D.V2))
def detect_v2(spark, sf_dir):
    return _detect(spark, sf_dir, D.V2)


@query("detect_service", _detect_sql(D.SERVICE, " AND 4700 - vid <= 4320"))
def detect_service(spark, sf_dir):
    return _detect(spark, sf_dir, D.SERVICE)


@query("detect_known", f"""WITH {OCC} SELECT DISTINCT vid, 400 AS code, CAST(NULL AS INTEGER) AS is_unique, CAST(NULL AS BIGINT) AS similar_vid, CAST(NULL AS DOUBLE) AS rate, 'had detected' AS msg
FROM occ WHERE vid % 2 = 0""")
def detect_known(spark, sf_dir):
    """Ids that are indexed already are refused."""
    _, items = sides(spark, sf_dir)
    return D.detect(items, items, D.V2)


def in_order_sql(v: D.Variant, order: str = "vid") -> str:
    """Sequences one by one: flags tells for each place of the order whether it leads; a sequence's candidates are listed by
    matches and filtered by the flags so far."""
    limit = f"[1:{v.cand_limit}]" if v.cand_limit else ""
    hits = f"list_filter(list_filter(cs, lambda x: flags[x.i]){limit}, lambda x: x.ok)"
    return f"""WITH RECURSIVE {_ALL}, io AS (SELECT * FROM occ), {BAGS},
nums AS MATERIALIZED (SELECT vid, n, row_number() OVER (ORDER BY {order}) AS i FROM nn),
pairs AS MATERIALIZED (SELECT q, c, matches, a.n AS nq, b.n AS nc, b.i AS ci FROM bags JOIN nums a ON a.vid = q JOIN nums b ON b.vid = c WHERE a.i > b.i AND a.n > 2 AND b.n > 2),
{WALK},
cand AS (SELECT q, list({{'i': ci, 'c': c, 'rate': repeated / nq, 'ok': repeated / nq >= 0.6 AND nc <= {v.ratio} * nq AND nq <= {v.ratio} * nc}} ORDER BY matches DESC, c) AS cs FROM pairs JOIN done USING (q, c) GROUP BY q),
el AS MATERIALIZED (SELECT vid, n, i, coalesce(cs, []) AS cs FROM nums LEFT JOIN cand ON q = vid),
steps AS (SELECT CAST(0 AS BIGINT) AS upto, CAST([] AS BOOLEAN[]) AS flags
  UNION ALL SELECT el.i, list_append(flags, n > 2 AND len({hits}) = 0) FROM steps JOIN el ON el.i = steps.upto + 1),
told AS (SELECT vid, n, {hits} AS hit FROM el, (SELECT flags FROM steps WHERE upto = (SELECT count(*) FROM nn)))"""


_LED = "SELECT vid, len(hit) = 0 AS leader, hit[1].c AS similar_vid FROM told"


@query("self_building_v2", f"{in_order_sql(D.V2)} {_LED}")
def self_building_v2(spark, sf_dir):
    """All documents one by one in order of id, each against those found unique before it."""
    return D.self_building(checkpointed(sequences(spark, sf_dir)), D.V2)


@query("self_building_service", f"{in_order_sql(D.SERVICE)} {_LED}")
def self_building_service(spark, sf_dir):
    """The same with ten candidates, the best of those found unique so far."""
    return D.self_building(checkpointed(sequences(spark, sf_dir)), D.SERVICE)


@query("index_update", f"""WITH RECURSIVE v AS ({_detect_sql(D.V2)}), {OCC}
SELECT vid, pos, hash FROM occ JOIN nn USING (vid) WHERE n > 2 AND vid IN (SELECT vid FROM v WHERE is_unique = 1)""".replace("WITH RECURSIVE v AS (WITH RECURSIVE", "WITH v AS (WITH RECURSIVE"))
def index_update(spark, sf_dir):
    q, items = sides(spark, sf_dir)
    return D.indexable(q, D.detect(q, items, D.V2)).select("vid", "pos", "hash")


@query("hash_lines", f"WITH {OCC} SELECT CAST(vid AS VARCHAR) || chr(9) || string_agg(hash, ' ' ORDER BY pos) AS value FROM occ GROUP BY vid")
def hash_lines(spark, sf_dir):
    return sinks.hash_lines(sequences(spark, sf_dir))


@query("status_log", f"""SELECT CASE WHEN is_unique = 1 THEN 'unique' ELSE 'repetitive' END AS status, '20240310' AS day, vid, msg, '2024-03-10 12:00:00' AS time FROM ({_detect_sql(D.V2)})""")
def status_log(spark, sf_dir):
    return sinks.status_rows(_detect(spark, sf_dir, D.V2), F.lit("2024-03-10 12:00:00").cast("timestamp"))


@query("responses", f"SELECT vid, is_unique = 0 AS has_same_video, similar_vid AS same_video, 0 AS err_code FROM ({_detect_sql(D.V2)})")
def responses(spark, sf_dir):
    from simlane.streaming import service

    return service.responses(_detect(spark, sf_dir, D.V2))


_INTRO = ["0000", "1111"]


@query("strip_intro", f"""WITH {OCC}, first AS (SELECT hash FROM occ WHERE pos = 0 GROUP BY hash ORDER BY count(*) DESC, hash LIMIT 1)
SELECT vid, CAST(count(*) - CASE WHEN min_by(hash, pos) = (SELECT hash FROM first) THEN 1 ELSE 0 END AS INTEGER) AS n FROM occ GROUP BY vid""")
def strip_intro(spark, sf_dir):
    """Sequence lengths without the most frequent opening."""
    occ = sequences(spark, sf_dir)
    top = occ.where("pos = 0").groupBy("hash").count().orderBy(F.col("count").desc(), "hash").limit(1).collect()
    lists = occ.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("h")).select("vid", F.transform("h", lambda x: x["hash"]).alias("h"))
    return lists.select("vid", F.size(S.strip_intro(F.col("h"), [r["hash"] for r in top] or _INTRO)).alias("n"))


@query("change_detection", """WITH RECURSIVE e AS (SELECT user_id AS vid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, value AS v, substr(md5(CAST(event_id AS VARCHAR)), 1, 4) AS hash FROM events),
s AS (SELECT vid, pos, v, hash, hash <> '0000' AS take, CASE WHEN hash <> '0000' THEN v END AS key FROM e WHERE pos = 1
  UNION ALL SELECT vid, pos, v, hash, take, CASE WHEN take THEN v ELSE key END FROM (
    SELECT e.vid, e.pos, e.v, e.hash, s.key, abs(e.v - s.v) > 20 AND (s.key IS NULL OR abs(e.v - s.key) > 20) AND e.hash <> '0000' AS take FROM s JOIN e ON e.vid = s.vid AND e.pos = s.pos + 1))
SELECT vid, coalesce(string_agg(hash, ' ' ORDER BY pos) FILTER (take), '') AS hashes FROM s GROUP BY vid""")
def change_detection(spark, sf_dir):
    """Events of a user as frames; a frame's feature is its value."""
    e = table(spark, sf_dir, "events")
    from pyspark.sql import Window

    pos = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int")
    frames = e.select(F.col("user_id").alias("vid"), pos.alias("pos"), F.array(F.col("value")).alias("feature"), F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 4).alias("hash"))
    return S.changes(frames, 20.0, ["0000"]).withColumn("hashes", F.array_join("hashes", " "))

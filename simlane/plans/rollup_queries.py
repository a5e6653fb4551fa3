"""Frame scores of events, sampling, batches, pairs and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from simlane.operators import geo, pairs, scoring
from simlane.operators import sequences as S
from simlane.plans.registry import query, table
from simlane.sources import sinks

_FRAMES = """f AS (SELECT user_id AS video, event_id, least(value / 100, 1.0) AS score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS idx FROM events)"""


def frames(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video"), "event_id", "ts", F.least(F.col("value") / 100, F.lit(1.0)).alias("score"))


def sampled(spark, sf_dir):
    return S.sample(frames(spark, sf_dir), 1, 5, "video", ["ts", "event_id"])


@query("sample_frames", f"WITH {_FRAMES} SELECT video, event_id, idx AS second FROM f WHERE idx % 5 = 0")
def sample_frames(spark, sf_dir):
    return sampled(spark, sf_dir).select("video", "event_id", "second")


@query("neighbour_frames", f"WITH {_FRAMES}, n AS (SELECT *, coalesce(lead(event_id) OVER (PARTITION BY video ORDER BY idx), event_id) AS copy FROM f) SELECT video, event_id, copy FROM n WHERE idx % 30 = 0")
def neighbour_frames(spark, sf_dir):
    return S.with_neighbour(frames(spark, sf_dir), 1, 30, "event_id", "video", ["ts", "event_id"]).select("video", "event_id", "copy")


@query("nsfw_conclusions", f"""WITH {_FRAMES}, s AS (SELECT video, idx AS second, score FROM f WHERE idx % 5 = 0)
SELECT video AS name, count(*) AS total_count, count(*) FILTER (score > 0.8) AS danger_count, count(*) FILTER (score > 0.5 AND score <= 0.8) AS warning_count,
  count(*) FILTER (score > 0.2 AND score <= 0.8) AS middle_count, count(*) FILTER (score <= 0.2) AS safe_count,
  coalesce(string_agg(CAST(second AS VARCHAR), ',' ORDER BY second) FILTER (score > 0.8), '') AS danger_second,
  coalesce(string_agg(CAST(second AS VARCHAR), ',' ORDER BY second) FILTER (score > 0.5 AND score <= 0.8), '') AS warning_second FROM s GROUP BY video""")
def nsfw_conclusions(spark, sf_dir):
    c = scoring.conclusions(sampled(spark, sf_dir))
    return c.withColumns({k: F.array_join(F.transform(k, lambda x: x.cast("string")), ",") for k in ("danger_second", "warning_second")})


@query("local_conclusions", f"""WITH {_FRAMES} SELECT video AS name, count(*) AS total_count, count(*) FILTER (score > 0.8) AS unsafe_count,
  count(*) FILTER (score >= 0.2 AND score <= 0.8) AS middle_count, count(*) FILTER (score < 0.2) AS safe_count FROM f GROUP BY video""")
def local_conclusions(spark, sf_dir):
    return scoring.local_conclusions(frames(spark, sf_dir))


@query("score_bands", f"""WITH {_FRAMES} SELECT CASE WHEN score > 0.8 THEN 'danger' WHEN score > 0.5 THEN 'warning' WHEN score > 0.2 THEN 'middle' ELSE 'safe' END AS band,
  CASE WHEN score > 0.8 THEN 'unsafe' WHEN score < 0.2 THEN 'safe' ELSE 'middle' END AS local_band, count(*) AS n FROM f GROUP BY ALL""")
def score_bands(spark, sf_dir):
    s = F.col("score")
    return frames(spark, sf_dir).groupBy(scoring.band(s).alias("band"), scoring.local_band(s).alias("local_band")).agg(F.count("*").alias("n"))


@query("class_accuracy", "SELECT avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END) AS accuracy FROM labels")
def class_accuracy(spark, sf_dir):
    return table(spark, sf_dir, "labels").agg(scoring.accuracy(F.lit(1) - F.col("toxic"), F.col("quality")).alias("accuracy"))


@query("batch_slice", """WITH n AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS idx, count(*) OVER () AS n FROM embeddings)
SELECT vec_id, CAST(((idx - (n - 3)) % n + n) % n AS INTEGER) AS slot FROM n WHERE ((idx - (n - 3)) % n + n) % n < 32""")
def batch_slice(spark, sf_dir):
    """A batch of 32 that begins three before the end."""
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    return S.batch_slice(e, ["vec_id"], e.count() - 3, 32)[0].select("vec_id", "slot")


@query("training_pairs", """WITH n AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS idx, count(*) OVER () AS n FROM embeddings),
o AS (SELECT idx, vec_id, ((idx + 1 + CAST('0x' || substr(md5(idx || ':42'), 1, 12) AS BIGINT) % (n - 1)) % n) AS other FROM n)
SELECT idx, vec_id AS "left", vec_id AS "right", 1 AS same FROM n
UNION ALL SELECT o.idx, o.vec_id, n.vec_id, 0 FROM o JOIN n ON n.idx = o.other""")
def training_pairs(spark, sf_dir):
    t = pairs.training_set(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", ["vec_id"])
    return t.select("idx", "left", "right", F.col("label")[0].alias("same"))


# Two provinces side by side, one of them a district; cities inside and across the border of the first.
_RINGS = [
    ("province", None, "A", "0,0;40,0;40,40;0,40"), ("province", None, "B", "40,0;80,0;80,20;60,20;60,40;40,40"), ("province", None, "D", "80,0;100,0;100,40;80,40"),
    ("city", "A", "A1", "0,0;20,0;20,20;0,20"), ("city", "A", "A2", "10,10;30,10;20,35"), ("city", "B", "B1", "40,0;60,0;60,20;40,20"), ("city", "D", "D1", "80,0;90,0;90,20;80,20"),
]


def rings(spark):
    values = ", ".join(f"({', '.join('NULL' if x is None else repr(x) for x in r)})" for r in _RINGS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(level, parent, code, line)").select("level", "parent", "code", geo.parse_ring(F.col("line")).alias("ring"))


def _geo_sql() -> str:
    edges = []
    for level, parent, code, line in _RINGS:
        p = [tuple(map(float, x.split(","))) for x in line.split(";")]
        for i, (x, y) in enumerate(p):
            u, v = p[i - 1]
            edges.append(f"('{level}', {'NULL' if parent is None else repr(parent)}, '{code}', {x}, {y}, {u}, {v})")
    return f"""e(level, parent, code, xi, yi, xj, yj) AS (VALUES {', '.join(edges)}),
crossed AS MATERIALIZED (SELECT y, level, parent, code, (xj - xi) * (y - yi) / (yj - yi) + xi AS xc FROM (SELECT DISTINCT y FROM p), e WHERE (yi > y) <> (yj > y)),
hits AS MATERIALIZED (SELECT p.id, level, parent, code FROM p JOIN crossed ON crossed.y = p.y WHERE x < xc GROUP BY ALL HAVING count(*) % 2 = 1),
top AS (SELECT id, min(code) AS parent FROM hits WHERE level = 'province' GROUP BY id),
city AS (SELECT t.id, min(h.code) AS city FROM top t JOIN hits h ON h.id = t.id AND h.level = 'city' AND h.parent = t.parent GROUP BY t.id)"""


_LOCATED = """SELECT p.id, CASE WHEN parent = 'D' OR city IS NULL THEN parent ELSE city END AS code,
  CASE WHEN parent IS NULL THEN 'none' WHEN parent = 'D' THEN 'district' WHEN city IS NULL THEN 'province' ELSE 'city' END AS kind
FROM p LEFT JOIN top USING (id) LEFT JOIN city USING (id)"""


@query("locate_points", f"WITH p AS (SELECT c_custkey AS id, c_acctbal / 100 AS x, CAST(c_custkey % 45 AS DOUBLE) AS y FROM customer), {_geo_sql()} {_LOCATED}")
def locate_points(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 100).alias("x"), (F.col("c_custkey") % 45).cast("double").alias("y"))
    return geo.locate(p, rings(spark), ["D"], step=10.0)


_GRID = "p AS MATERIALIZED (SELECT CAST(ix AS VARCHAR) || CAST(iy AS VARCHAR) AS id, ix / 100.0 AS x, iy / 100.0 AS y FROM range(1900, 2100) a(ix), range(1000, 1200) b(iy))"


@query("grid_codes", f"WITH {_GRID}, {_geo_sql()} {_LOCATED}")
def grid_codes(spark, sf_dir):
    return geo.locate(geo.grid(spark, 1900, 2100, 1000, 1200), rings(spark), ["D"], step=10.0)


@query("grid_lines", f"WITH {_GRID}, {_geo_sql()} SELECT id || chr(9) || code AS value FROM ({_LOCATED}) WHERE code IS NOT NULL")
def grid_lines(spark, sf_dir):
    return sinks.grid_lines(grid_codes(spark, sf_dir))


@query("first_records", """SELECT user_id, event_id, event_type FROM events WHERE value > 10
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) = 1""")
def first_records(spark, sf_dir):
    """The first accepted record of each user, latest day first."""
    from simlane.operators.text import first_records as first

    e = table(spark, sf_dir, "events").where("value > 10")
    return first(e, "user_id", [F.to_date("ts").desc(), F.col("event_id").asc()]).select("user_id", "event_id", "event_type")


@query("recent_occurrences", "SELECT event_id FROM events WHERE epoch(TIMESTAMP '2024-07-15 00:00:00') - floor(epoch(ts)) <= 86400 * 180")
def recent_occurrences(spark, sf_dir):
    """Occurrences of at most 180 days."""
    from simlane.operators.dedup import fresh

    return fresh(table(spark, sf_dir, "events"), F.lit("2024-07-15 00:00:00").cast("timestamp"), 180).select("event_id")


@query("shuffled_order", "SELECT vec_id, row_number() OVER (ORDER BY md5(vec_id || ':7'), vec_id) AS place FROM embeddings")
def shuffled_order(spark, sf_dir):
    """A random order that a seed fixes."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.md5(F.concat_ws(":", F.col("vec_id").cast("string"), F.lit("7")).cast("binary")).alias("k"))
    n, _ = S.numbered_rows(e, ["k", "vec_id"])
    return n.select("vec_id", (F.col("idx") + 1).alias("place"))



"""One registered query per training-data operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from simlane.llm import ann_bits, divergence, exact_topk, langid, lm_score, mixing, packing, periodic, pii, quality, simhash, vector_codes, warc
from simlane.llm.common import pick

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _read(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_stupid_backoff(spark, sf_dir):
    """Trigram scores of all documents by the counts of all others."""
    s = lm_score.scores(_read(spark, sf_dir, "documents"))
    return s.withColumn("log_score", F.round("log_score", 3)).withColumn("score", F.round("score", 6))


ORACLES["op1_stupid_backoff"] = lm_score.ORACLE


@_query
def op2_byte_gru(spark, sf_dir):
    """The language of all documents."""
    return langid.identify(_read(spark, sf_dir, "documents"))


@_query
def op3_rotated_bits(spark, sf_dir):
    """The 20 nearest by inner product of every 20th vector."""
    e = pick(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return ann_bits.nearest(e, e.where(F.col("vec_id") % 20 == 0), k=20)


@_query
def op4_simhash(spark, sf_dir):
    """Fingerprints of all documents and what they link to within three bits."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@_query
def op5_pivot_distance(spark, sf_dir):
    """The 10 highest integer inner products of every 100th vector."""
    e = pick(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_topk.top_k(e, e.where(F.col("vec_id") % 100 == 0), k=10)


ORACLES["op5_pivot_distance"] = """WITH w AS (
  SELECT vec_id, min(embedding) AS embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM w),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10"""


@_query
def op6_weak_pii(spark, sf_dir):
    """Personal data in all documents."""
    return pii.spans(_read(spark, sf_dir, "documents"))


@_query
def op7_poisson_mix(spark, sf_dir):
    """Sources at shares that follow the square root of their size."""
    return mixing.poisson_mix(_read(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


ORACLES["op7_poisson_mix"] = mixing.oracle_sql()


@_query
def op8_nb_svm(spark, sf_dir):
    """Quality of all documents, learned from the labels that aren't held out."""
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query
def op9_length_buckets(spark, sf_dir):
    """Eight optimal buckets of at most 2048 tokens, batches of 16384."""
    return packing.pack(_read(spark, sf_dir, "documents"))


ORACLES["op9_length_buckets"] = packing.oracle_sql()


@_query
def op10_zstd_warc(spark, sf_dir):
    """All pages written to archives and read back."""
    return warc.archived(_read(spark, sf_dir, "pages"))


ORACLES["op10_zstd_warc"] = warc.ORACLE


@_query
def op11_partition_runs(spark, sf_dir):
    """Periodic runs of words in all documents, every tenth of which gets one planted."""
    return periodic.periodic_runs(_read(spark, sf_dir, "documents"), plant=True)


@_query
def op12_divergence(spark, sf_dir):
    """Quality rules on all documents."""
    return divergence.judged(_read(spark, sf_dir, "documents"))


ORACLES["op12_divergence"] = divergence.oracle_sql()


@_query
def op13_exponion_codes(spark, sf_dir):
    """Product codes of all vectors: 8 parts, 16 entries, 6 rounds."""
    return vector_codes.compressed(_read(spark, sf_dir, "embeddings"))


ORACLES["op13_exponion_codes"] = vector_codes.oracle_sql()

"""Recommendation queries over the embeddings table; the tag of a vector is 'tag' and its label."""

from __future__ import annotations

from pyspark.sql import functions as F

from simlane.operators import similarity as S
from simlane.plans.registry import query, table

_DOT = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))"


def _items(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.array(F.concat(F.lit("tag"), F.lpad(F.col("label").cast("string"), 3, "0"))).alias("tags"))


def _sql(score: str, test: str, order: str) -> str:
    return f"""WITH p AS (SELECT a.vec_id AS doc, b.vec_id AS video, {score} AS s
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT doc, video, s, row_number() OVER (PARTITION BY doc ORDER BY s {order}, video) AS rank FROM p WHERE {test})
SELECT doc, video, round(s, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 40"""


_COS = f"{_DOT.format(a='a.embedding', b='b.embedding')} / (sqrt({_DOT.format(a='a.embedding', b='a.embedding')}) * sqrt({_DOT.format(a='b.embedding', b='b.embedding')}))"
_L2 = "sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE))))"


def _run(spark, sf_dir, metric, threshold):
    x = _items(spark, sf_dir)
    return S.recommend(x, x, metric, threshold, 40, same=False).select("doc", "video", F.round("score", 6).alias("score"), "rank")


@query("recommend_cosine", _sql(_COS, "s >= 0.2", "DESC"))
def recommend_cosine(spark, sf_dir):
    return _run(spark, sf_dir, "cosine", 0.2)


@query("recommend_euclid", _sql(_L2, "s <= 1.25", "ASC"))
def recommend_euclid(spark, sf_dir):
    return _run(spark, sf_dir, "euclid", 1.25)

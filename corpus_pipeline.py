"""A pipeline from raw documents to packed batches, each stage one of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simlane.llm import mixing, near_copies, packing, pii, quality
from simlane.llm.common import pick, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that aren't held out, scores at 0.5 or more, in as many rows as
    they have. Null and empty texts get the score of the bias and stay or go with it; without labels all scores are 0.5
    and all stay. Null ids and columns are kept as they are, other columns dropped; an empty table gives no rows."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model, *COLUMNS).where(F.col("quality_score") >= 0.5).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more), that with the least id.
    Null texts and texts without words are one group; repeated rows stay once; of several rows of the kept id and shingles
    the least by text, lang, source and n_chars stays; a group of null ids only keeps one row."""
    return near_copies.drop_near_copies(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in as many rows as they have, personal data replaced by its kind and n_chars set anew where it was.
    Null texts stay null, texts without personal data as they are."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target shares, in a shuffled order. The null source is one
    of its own; rows of equal id are drawn alike, those without an id by their text; a source of empty texts keeps rate 1."""
    return mixing.poisson_mix(docs).select(*COLUMNS)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces of similar length. Null and empty texts are a piece of an end mark; repeated rows are packed as
    often as they occur; an empty table gives no batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: SQL can't state the trained stages; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table; what a stage keeps is written before the next reads it."""
    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), *COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs

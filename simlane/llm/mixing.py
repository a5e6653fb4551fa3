"""Mixing of sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import pick, staged, unit

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows of the table of sources up to which it may be broadcast (a row has a rate and the steps of its distribution).
BROADCAST_SOURCES = 1_000
#: Steps of all distributions together up to which the table may be broadcast: 8 MB of doubles.
BROADCAST_STEPS = 1_000_000


def poisson_steps(rate: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... until what is left is below 2^-53; terms are kept as logarithms, so that no rate underflows."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(s: Column, k: Column) -> Column:
        log = s["log"] + F.log(rate) - F.log(k.cast("double"))
        total = s["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(s["steps"], F.array(total)).alias("steps"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["steps"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, total: float = 1.0) -> DataFrame:
    """Per source its size in characters and the mean number of copies that gives it its target share of
    total x the corpus's characters. weights: relative target shares, 0 for a source not named; without them a
    source's share follows its size to the power alpha. The null source is a source of its own ('' is another)."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    sizes = docs.groupBy(key.alias("source_key")).agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        w = F.pow("size", F.lit(float(alpha)))
    else:
        w = F.lit(0.0)
        for name, x in weights.items():
            w = F.when(F.col("source_key") == "=" + name, F.lit(float(x))).otherwise(w)
    sizes = staged(sizes.withColumn("weight", F.when(F.col("size") > 0, w).otherwise(0.0)))
    sums = sizes.agg(F.sum("size"), F.sum("weight")).first()
    all_size, all_weight = (float(x or 0) for x in sums)
    rate = F.lit(total * all_size) * F.col("weight") / F.lit(all_weight or 1.0) / F.col("size")
    return sizes.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(1.0)))


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, total: float = 1.0, seed: int = 42) -> DataFrame:
    """Each document as many times as a Poisson variable of its source's rate says, in an order shuffled over all
    partitions. Returns the columns of documents, rate, copy (from 1) and order_key.

    The variable is inverted from a number in (0, 1) hashed from seed and doc_id, so a rerun or a lost executor
    gives the same copies. Rows with equal doc_id get equal counts; a row without an id is known by its text's MD5, so
    that such rows are drawn and dealt apart. Null or empty texts have size 0: in a source of only such texts the rate
    is 1. Other columns are dropped. An empty table gives none. A hot source needs no care: rates come from one
    pre-aggregated sum a task. The copies are dealt by order_key and the input split they come from, so that a row
    that is repeated without end doesn't meet in one task either."""
    docs = pick(docs, *COLUMNS)
    rates = source_rates(docs, weights, alpha, total).select("source_key", "rate", poisson_steps(F.col("rate")).alias("steps"))
    rates = staged(rates)
    n, steps = rates.agg(F.count("*"), F.sum(F.size("steps"))).first()
    small = n <= BROADCAST_SOURCES and (steps or 0) <= BROADCAST_STEPS
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    joined = docs.withColumn("source_key", key).join(F.broadcast(rates) if small else rates, "source_key")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    u = unit(F.lit(seed), name)
    copies = joined.withColumn("_n", F.size(F.filter("steps", lambda c: c < u))).where(F.col("_n") > 0)
    out = copies.select(*COLUMNS, "rate", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    out = out.withColumn("order_key", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), name, F.col("copy").cast("string"))))
    out = out.withColumn("_split", F.spark_partition_id())
    return out.repartition("order_key", "_split").drop("_split").sortWithinPartitions("order_key")


def oracle_sql(docs: str = "documents", alpha: float = 0.5, total: float = 1.0, seed: int = 42) -> str:
    """The rows of poisson_mix in DuckDB's SQL."""
    return f"""WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM {docs} GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN {float(total)} * (SELECT sum(size) FROM sizes) * pow(size, {float(alpha)})
    / (SELECT sum(CASE WHEN size > 0 THEN pow(size, {float(alpha)}) ELSE 0 END) FROM sizes) / size ELSE 1 END AS rate FROM sizes),
steps AS (
  SELECT source, rate, 0 AS k, -rate AS l, exp(-rate) AS c FROM rates
  UNION ALL SELECT source, rate, k + 1, l + ln(rate) - ln(k + 1), c + exp(l + ln(rate) - ln(k + 1)) FROM steps
  WHERE rate > 0 AND k < ceil(rate + 12 * sqrt(rate) + 30)),
n AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS name FROM {docs}),
d AS (SELECT *, (CAST('0x' || substr(md5('{seed}:' || name), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM n)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, round(s.rate, 9) AS rate, CAST(s.k + 1 AS INTEGER) AS copy,
  md5('{seed}:order:' || d.name || ':' || (s.k + 1)) AS order_key
FROM d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.c < d.u"""

"""Packing into optimal length buckets with token-budget batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simlane.llm.common import pick

#: The words of a text, the unit of length unless a caller gives another.
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Places of equal pieces that are made at once.
RANGE = 4096


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    parts = F.split(t, WORD_BREAK)
    return F.size(parts) - F.when(F.element_at(parts, 1) == "", 1).otherwise(0) - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most `buckets` upper bounds, taken from the sorted distinct lengths, that minimise the total padding
    sum(count x (bound - length)); among equal ones the first found. Exact, in buckets x distinct lengths^2 steps."""
    lengths, counts = np.asarray(lengths, np.float64), np.asarray(counts, np.float64)
    n = len(lengths)
    if n == 0:
        return []
    c, cl = np.r_[0.0, np.cumsum(counts)], np.r_[0.0, np.cumsum(counts * lengths)]
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    back: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        new, came = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (cl[j] - cl[:j])
            came[j] = i = int(np.argmin(cost))
            new[j] = cost[i]
        back.append(came)
        best = new
    bounds, j = [], n
    for came in reversed(back):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(came[j])
    return sorted(set(bounds))


def pieces(docs: DataFrame, max_len: int = 2048, length: Column | None = None) -> DataFrame:
    """doc_id, piece (from 0), first (token offset), n_tokens and name (by the id or, where it is null, the text). A text has its words and one end mark; one of more
    than max_len tokens is cut into pieces of max_len and a rest, so nothing is lost. Null and empty texts have the
    end mark alone."""
    d = pick(docs, "doc_id", "text")
    n = (word_count(F.col("text")) if length is None else length) + 1
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    d = d.select("doc_id", n.cast("long").alias("_n"), name.alias("_name"))
    at = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(max_len).cast("long")))
    size = F.least(F.lit(max_len).cast("long"), F.col("_n") - F.col("first"))
    return d.select("doc_id", "_n", "_name", at.alias("piece", "first")).select("doc_id", "piece", "first", size.alias("n_tokens"), F.concat_ws(":", "_name", F.col("piece").cast("string")).alias("name"))


def pack(docs: DataFrame, buckets: int = 8, max_len: int = 2048, token_budget: int = 16384, shard_rows: int = 8192, seed: int = 42, length: Column | None = None) -> DataFrame:
    """Batches of pieces of similar length. Returns doc_id, piece, first, n_tokens, bucket_len (the padded length),
    batch_id and slot (the place in the batch). A batch holds token_budget // bucket_len pieces (one at least).

    The histogram of all lengths has at most max_len rows; only it comes to the driver, where the boundaries are
    chosen. A bucket is dealt by hash into shards of about shard_rows rows, so that a bucket with most of the rows is
    filled by many tasks; each shard ends with at most one batch that is not full. Repeated rows are packed as often
    as they occur: equal pieces are counted before they are dealt, take consecutive places and are written out after
    that, in ranges that are dealt to all tasks, so a row repeated without end doesn't fill one. Rows without an id are dealt by their text's MD5. An empty
    table gives no rows; other columns are ignored."""
    p = pieces(docs, max_len, length)
    hist = sorted((int(r[0]), int(r[1])) for r in p.groupBy("n_tokens").count().collect())
    lengths, counts = np.array([x for x, _ in hist]), np.array([x for _, x in hist])
    bounds = best_boundaries(lengths, counts, buckets) or [max_len]
    bucket = shards = F.lit(None)
    low = 0
    for b in bounds:
        rows = int(counts[(lengths > low) & (lengths <= b)].sum()) if len(hist) else 0
        low = b
        test = F.col("n_tokens") <= b
        bucket = F.when(bucket.isNull() & test, F.lit(b)).otherwise(bucket)
        shards = F.when(shards.isNull() & test, F.lit(-(-rows // shard_rows) or 1)).otherwise(shards)
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "name")), 1, 8), 16, 10).cast("long")
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), "name"))
    p = p.select("*", bucket.cast("int").alias("bucket_len"), F.pmod(key, shards.cast("long")).alias("_shard"), order.alias("_order"))
    columns = ["doc_id", "piece", "first", "n_tokens", "bucket_len", "_shard", "_order"]
    p = p.groupBy(*columns).agg(F.count("*").alias("_rows"))
    w = Window.partitionBy("bucket_len", "_shard").orderBy("_order", "doc_id", "piece", "n_tokens", "first")
    before = F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    room = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_len"))).cast("long")
    # places of many equal pieces are written out range by range, by many tasks
    ranges = p.withColumn("_before", before).withColumn("_range", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_rows") - 1) / RANGE))))
    ranges = ranges.repartition("_order", "_range").withColumn("_from", F.col("_before") + F.col("_range") * RANGE)
    at = ranges.withColumn("_at", F.explode(F.sequence("_from", F.least(F.col("_from") + RANGE, F.col("_before") + F.col("_rows")) - 1)))
    batch = F.concat_ws("-", F.col("bucket_len").cast("string"), F.col("_shard").cast("string"), F.floor(F.col("_at") / room).cast("string"))
    return at.select("doc_id", "piece", "first", "n_tokens", "bucket_len", batch.alias("batch_id"), F.pmod("_at", room).cast("int").alias("slot"))


def oracle_sql(docs: str = "documents", buckets: int = 8, max_len: int = 2048, token_budget: int = 16384, shard_rows: int = 8192, seed: int = 42) -> str:
    """The rows of pack in DuckDB's SQL. dp holds, for each number of buckets, the least padding of the first j lengths
    and where the last bucket begins; bt walks back through it."""
    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS n FROM {docs}),
p AS (SELECT doc_id, id, CAST(i AS INTEGER) AS piece, CAST(i * {max_len} AS BIGINT) AS first, CAST(least({max_len}, n - i * {max_len}) AS BIGINT) AS n_tokens
  FROM (SELECT doc_id, id, n, unnest(range(0, (n - 1) // {max_len} + 1)) AS i FROM d)),
h AS (SELECT n_tokens AS l, count(*) AS c FROM p GROUP BY 1),
s AS (SELECT l, CAST(sum(c) OVER (ORDER BY l) AS DOUBLE) AS c, CAST(sum(c * l) OVER (ORDER BY l) AS DOUBLE) AS cl FROM h),
b AS (SELECT list(CAST(l AS DOUBLE) ORDER BY l) AS ls, list_prepend(0.0, list(c ORDER BY l)) AS c, list_prepend(0.0, list(cl ORDER BY l)) AS cl, count(*) AS m FROM s),
dp AS (
  SELECT 0 AS k, list_prepend(0.0, list_transform(ls, lambda x: CAST('inf' AS DOUBLE))) AS best, CAST([] AS BIGINT[]) AS back FROM b
  UNION ALL SELECT k + 1, list_prepend(0.0, list_transform(costs, lambda x: list_min(x))), list_prepend(CAST(0 AS BIGINT), list_transform(costs, lambda x: CAST(list_position(x, list_min(x)) - 1 AS BIGINT)))
  FROM (SELECT k, list_transform(range(1, m + 1), lambda j: list_transform(range(0, j), lambda i: best[i + 1] + ls[j] * (c[j + 1] - c[i + 1]) - (cl[j + 1] - cl[i + 1]))) AS costs
    FROM dp, b WHERE k < least({buckets}, m))),
bt AS (
  SELECT k, m AS j FROM dp, b WHERE k = least({buckets}, m) AND m > 0
  UNION ALL SELECT bt.k - 1, dp.back[bt.j + 1] FROM bt JOIN dp ON dp.k = bt.k WHERE dp.back[bt.j + 1] > 0),
bounds AS (SELECT DISTINCT CAST(ls[j] AS INTEGER) AS bucket_len FROM bt, b),
placed AS (SELECT p.*, (SELECT min(bucket_len) FROM bounds WHERE bucket_len >= n_tokens) AS bucket_len, id || ':' || piece AS name FROM p),
room AS (SELECT bucket_len, greatest(1, {token_budget} // bucket_len) AS room, CAST(ceil(count(*) / {shard_rows}) AS BIGINT) AS shards FROM placed GROUP BY bucket_len),
dealt AS (SELECT *, CAST('0x' || substr(md5('{seed}:' || name), 1, 8) AS BIGINT) % shards AS shard FROM placed JOIN room USING (bucket_len)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket_len, shard ORDER BY md5('{seed}:order:' || name), doc_id NULLS FIRST, piece, n_tokens, first) - 1 AS place FROM dealt)
SELECT doc_id, piece, first, n_tokens, bucket_len, bucket_len || '-' || shard || '-' || (place // room) AS batch_id, CAST(place % room AS INTEGER) AS slot FROM numbered"""

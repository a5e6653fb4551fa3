"""Product codes of vectors, fitted by exponion search in whole numbers.

A vector is cut into parts, each of which is replaced by the index of the nearest entry of its codebook. A round assigns
all parts and moves the entries to the means of theirs. The search of a part starts at the entry that it had in the
round before, at distance d: an entry as near as that lies within 2 d of it (triangle inequality), so of that entry's
neighbours, sorted by distance, only the beginning up to 2 d is scanned. All distances are squares of whole numbers, compared
exactly (4 d^2), and ties go to the lower index, so the codes are those of a search of all entries.

Vectors are packed into blocks, written once and hashed by block. What a round yields is written apart from them: the codes, joined
to the blocks by number in the next round (the blocks themselves aren't shuffled again), and one row of sums for each task. Only
the sums over all tasks, 16 entries a part, come to the driver."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simlane.llm.common import frugal, pick, staged

#: Parts of a vector, entries of a codebook, rounds, and the factor by which components become whole numbers.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block.
BLOCK = 2048
CODES = "block long, codes binary, dim int, part int, entry int, sums array<long>, n long"


def cuts(dim: int) -> list[slice]:
    """Equal consecutive parts; where the dimension has a remainder their ends are rounded down."""
    return [slice(i * dim // PARTS, (i + 1) * dim // PARTS) for i in range(PARTS)]


def whole(df: DataFrame) -> DataFrame:
    """vec_id, label and v, the components as whole numbers, of rows whose vector is not null and has no null or non-finite component."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    ok = pick(df, "vec_id", "embedding", "label").where(x.isNotNull() & ~bad)
    return ok.select("vec_id", "label", F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))


class Codebook:
    """Entries of one part (entries x components), with each entry's neighbours by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gap = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.order = np.lexsort((np.broadcast_to(np.arange(len(entries)), gap.shape), gap), axis=1)
        self.gap = np.take_along_axis(gap, self.order, axis=1)

    def search(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries of the rows of x and their squared distances, from a start entry for each."""
        first = ((x - self.entries[start]) ** 2).sum(axis=1)
        best, dist = start.copy(), first.copy()
        rows = np.arange(len(x))
        for place in range(len(self.entries)):
            rows = rows[self.gap[start[rows], place] <= 4 * first[rows]]
            if not len(rows):
                break
            entry = self.order[start[rows], place]
            d = ((x[rows] - self.entries[entry]) ** 2).sum(axis=1)
            nearer = (d < dist[rows]) | ((d == dist[rows]) & (entry < best[rows]))
            best[rows[nearer]], dist[rows[nearer]] = entry[nearer], d[nearer]
        return best, dist


def assigned(x: np.ndarray, start: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (vectors x parts) and squared distances summed over parts."""
    codes, error = np.empty((len(x), PARTS), np.int64), np.zeros(len(x), np.int64)
    for i, (at, book) in enumerate(zip(cuts(x.shape[1]), books, strict=True)):
        codes[:, i], d = book.search(x[:, at], start[:, i].astype(np.int64))
        error += d
    return codes, error


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of vectors of one dimension: block, dim, ids, labels, vecs; hashed by block and written."""
    kind = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("ids", T.ArrayType(rows.schema["vec_id"].dataType)),
        T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)), T.StructField("vecs", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = b.column("v").value_lengths().to_numpy()
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                for lo in range(0, len(own), BLOCK):
                    some = b.take(pa.array(own[lo : lo + BLOCK]))
                    lists = [pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column(c)) for c in ("vec_id", "label")]
                    v = some.column("v").flatten().to_numpy().astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([int(d)], pa.int32()), *lists, pa.array([small(v).tobytes()], pa.binary())], names=["block", "dim", "ids", "labels", "vecs"])
                    at += 1

    blocks = rows.mapInArrow(frugal(run), kind)
    conf = rows.sparkSession.conf
    kept = conf.get("spark.sql.adaptive.enabled")
    try:
        conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan doesn't pass on that its rows are hashed
        return staged(blocks.repartition(int(conf.get("spark.sql.shuffle.partitions")), "block"))
    finally:
        conf.set("spark.sql.adaptive.enabled", kept)


def small(v: np.ndarray) -> np.ndarray:
    """Whole numbers in four bytes where all fit, else in eight."""
    return v.astype(np.int32) if not len(v) or max(-int(v.min()), int(v.max())) < 2**31 else v


def unpacked(vecs: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.int32 if n * dim and len(vecs) == 4 * n * dim else np.int64
    return np.frombuffer(vecs, kind).reshape(n, dim).astype(np.int64)


def first_entries(rows: DataFrame) -> dict[int, np.ndarray]:
    """By dimension the vectors of the smallest ids, in order: ENTRIES at most. The dimensions of a table are few."""
    out = {}
    for d in sorted(r[0] for r in rows.select(F.size("v")).distinct().collect()):
        own = rows.where(F.size("v") == d).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
        out[d] = np.array([r["v"] for r in own], np.int64).reshape(len(own), d)
    return out


def met(blocks: DataFrame, codes: DataFrame | None) -> DataFrame:
    """Blocks with the codes of the last round; none in the first."""
    if codes is None:
        return blocks.withColumn("codes", F.lit(None).cast("binary"))
    return blocks.join(codes.where("block is not null").select("block", "codes").hint("shuffle_hash"), "block")


def started(row: dict, n: int) -> np.ndarray:
    return np.zeros((n, PARTS), np.int64) if row["codes"] is None else np.frombuffer(row["codes"], np.uint8).reshape(n, PARTS)


def round_of(books: dict[int, list[Codebook]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of each block, and at the end of a task the sums and counts of the parts of each entry."""
    sums = {d: [np.zeros((len(b.entries), b.entries.shape[1]), np.int64) for b in books[d]] for d in books}
    counts = {d: [np.zeros(len(b.entries), np.int64) for b in books[d]] for d in books}
    schema = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("dim", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64())), ("n", pa.int64())])
    for b in batches:
        for row in b.select(["block", "dim", "vecs", "codes", "n"]).to_pylist():
            x = unpacked(row["vecs"], row["n"], row["dim"])
            codes, _ = assigned(x, started(row, len(x)), books[row["dim"]])
            for i, at in enumerate(cuts(row["dim"])):
                np.add.at(sums[row["dim"]][i], codes[:, i], x[:, at])
                counts[row["dim"]][i] += np.bincount(codes[:, i], minlength=len(counts[row["dim"]][i]))
            yield pa.RecordBatch.from_pylist([{"block": row["block"], "codes": codes.astype(np.uint8).tobytes()}], schema)
    for d in sums:
        rows = [{"dim": d, "part": i, "entry": j, "sums": sums[d][i][j].tolist(), "n": int(n)} for i in range(PARTS) for j, n in enumerate(counts[d][i]) if n]
        yield pa.RecordBatch.from_pylist(rows, schema)


def moved(entries: dict[int, list[np.ndarray]], results: DataFrame) -> dict[int, list[np.ndarray]]:
    """Entries at the means, rounded down, of their parts; those without any stay."""
    places = results.where("part is not null").select("dim", "part", "entry", "n", F.posexplode("sums").alias("place", "x"))
    total = places.groupBy("dim", "part", "entry", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    out = {d: [e.copy() for e in books] for d, books in entries.items()}
    for r in total.collect():
        out[r["dim"]][r["part"]][r["entry"], r["place"]] = int(r["x"]) // r["n"]
    return out


def compressed(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 for each row of embeddings (vec_id,
    embedding, label) that has a whole vector; the others are dropped, empty vectors have no error.

    Repeated rows are all kept and counted; null ids come last among the first entries; equal ids are taken by vector. Vectors
    of fewer components than parts leave parts empty. Vectors of several dimensions have codebooks for each, and the digest
    of theirs. Fewer rows than entries give fewer entries; an empty table gives no rows. label_error is the sum over the rows
    of a label, null labels together. Squared distances must fit a long: components beyond that end in an error, as no
    result could hold them. A lost task is done again from the written blocks and codes."""
    rows = whole(embeddings)
    n_rows, most = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double")))))).first()
    first = first_entries(rows)
    if n_rows and 4 * float(most) ** 2 * max(1, *first) >= 2.0**61:
        raise ValueError(f"components reach {most}: squared distances don't fit a long")
    entries = {d: [v[:, at].copy() for at in cuts(d)] for d, v in first.items()}
    blocks = packed(rows).withColumn("n", F.size("ids").cast("long"))
    codes = None
    for _ in range(rounds):
        books = {d: [Codebook(e) for e in parts] for d, parts in entries.items()}
        codes = staged(met(blocks, codes).mapInArrow(frugal(lambda batches, books=books: round_of(books, batches)), CODES))
        entries = moved(entries, codes)
    books = {d: [Codebook(e) for e in parts] for d, parts in entries.items()}
    digest = {d: hashlib.sha256(",".join(str(x) for e in parts for x in e.ravel().tolist()).encode()).hexdigest() for d, parts in entries.items()}
    kinds = {f: rows.schema[f].dataType for f in ("vec_id", "label")}
    kind = T.StructType([T.StructField("vec_id", kinds["vec_id"]), T.StructField("label", kinds["label"]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, row in enumerate(b.select(["dim", "vecs", "codes", "n"]).to_pylist()):
                x = unpacked(row["vecs"], row["n"], row["dim"])
                found, error = assigned(x, started(row, len(x)), books[row["dim"]])
                text = found.astype(np.uint8).tobytes().hex()
                w = 2 * PARTS
                yield pa.RecordBatch.from_arrays([
                    b.column("ids")[i].values, b.column("labels")[i].values, pa.array([text[j : j + w] for j in range(0, len(text), w)], pa.string()), pa.array(error), pa.array([digest[row["dim"]]] * len(x), pa.string()),
                ], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    coded = staged(met(blocks, codes).mapInArrow(frugal(final), kind))
    labels = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def oracle_sql() -> str:
    """The rounds one after the other, with all entries compared."""
    nearest = "SELECT r, part, entry, d FROM (SELECT v.r, v.part, c.entry, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN {c} c ON c.part = v.part AND c.place = v.place GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1"
    steps = []
    for i in range(ROUNDS):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(c=f'c{i}')})")
        steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.place, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT part, entry, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT v.part, a.entry, v.place, sum(v.x) AS s, count(*) AS n FROM v JOIN a{i} a ON a.r = v.r AND a.part = v.part GROUP BY ALL)) m
  ON m.part = c.part AND m.entry = c.entry AND m.place = c.place)""")
    return f"""WITH w AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT r, len(embedding) AS dim, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM w),
v AS MATERIALIZED (SELECT r, i * {PARTS} // dim AS part, i % (dim // {PARTS}) AS place, CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT) AS x FROM u),
c0 AS MATERIALIZED (SELECT part, r AS entry, place, x FROM v WHERE r < {ENTRIES}),
{", ".join(steps)},
f AS MATERIALIZED ({nearest.format(c=f"c{ROUNDS}")}),
g AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM w JOIN g USING (r), h"""

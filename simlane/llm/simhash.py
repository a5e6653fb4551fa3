"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that differ in at most `radius` bits agree in some of the word's parts, which gives exact candidate
buckets. Within a bucket the fingerprints are stored as bit planes: 64 of them lie side by side in a machine word,
a carry-save counter of a few planes adds up all their distances to a query at once, and a block of 64 is abandoned
once all its lanes have passed the radius."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import frugal, pick, slices, staged
from simlane.llm.components import components

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints of one bucket that a task compares at once; a larger bucket is cut into pairs of parts.
BUCKET_ROWS = 16384
#: Small buckets are compared together up to about so many lanes.
LANES = 512
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of a text that are split into words at once.
SLICE = 4_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the whole text: words of the text with A-Z lower-cased, shingles with repeats, XXH64; a bit is
    1 if it is set in over half the hashes. Fewer words than a shingle: one hash of all; none or null: 0."""
    digest = xxhash.xxh64_intdigest
    count, n = np.zeros(64, np.int64), 0
    words: list[bytes] = []

    def add(h: np.ndarray) -> None:
        nonlocal count, n
        count = count + np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        n += len(h)

    for part in slices((text or "").encode("utf-8", "surrogatepass").lower(), SLICE):
        # the last words of the slice before begin the shingles that reach into this one
        words = words[max(0, len(words) - shingle + 1) :] if len(words) >= shingle else words
        words = words + part.split()
        if len(words) < shingle:
            continue
        whole = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        for lo in range(0, len(starts), 32768):
            add(np.array([digest(whole[s:e], seed) for s, e in zip(starts[lo : lo + 32768], ends[lo : lo + 32768], strict=True)], np.uint64))
    if not n and words:
        add(np.array([digest(b" ".join(words), seed)], np.uint64))
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in b["text"]), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return pick(docs, "doc_id", "text").mapInArrow(frugal(run), "doc_id long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    """A row of bits (0 or 1) for each fingerprint of one or more 64-bit words, least bit first."""
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 lanes a word; the last word is filled with zeros."""
    bits = np.pad(_bits(fps), ((0, -len(fps) % 64), (0, 0)))
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_lanes(fps: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, lanes j > i within the radius) for each i that has any. fps: 64-bit numbers, or rows of several.

    The first quarter of the planes is added up for all blocks of a tile of rows; from then on only the (row, block)
    pairs live on in which some lane is still within the radius, and each eight planes thin them out again."""
    n = len(fps)
    if n < 2:
        return
    p = planes(fps)
    depth, words = p.shape
    width = max(1, radius.bit_length())
    start = 2**width - 1 - radius  # so that a counter overflows just when it passes the radius
    tile = max(16, 65536 // words)
    lane = np.arange(words * 64)
    none = np.uint64(0)
    for lo in range(0, n, tile):
        rows = np.arange(lo, min(n, lo + tile))
        skip = lo // 64
        flip = np.where(_bits(fps[lo : lo + tile]) == 1, ALL, none)
        shut = (lane[None, skip * 64 :] <= rows[:, None]) | (lane[None, skip * 64 :] >= n)
        over = np.packbits(shut, axis=1, bitorder="little").view(np.uint64)
        counter = [np.full(over.shape, ALL if start >> w & 1 else none) for w in range(width)]
        row = block = None
        for b in range(depth):
            carry = p[b, skip:][None, :] ^ flip[:, b][:, None] if row is None else p[b, block] ^ flip[row, b]
            for w in range(width):
                counter[w], carry = counter[w] ^ carry, counter[w] & carry
            over |= carry
            if b % 8 == 7 and b + 1 >= depth // 4:
                alive = over != ALL
                if row is None:
                    row, block = np.nonzero(alive)
                    block = block + skip
                else:
                    row, block = row[alive], block[alive]
                over, counter = over[alive], [c[alive] for c in counter]
                if not len(over):
                    break
        if not len(over):
            continue
        begins = np.r_[0, np.flatnonzero(np.diff(row)) + 1, len(row)]
        for s, e in zip(begins[:-1], begins[1:], strict=True):
            near = np.unpackbits((~over[s:e]).view(np.uint8).reshape(e - s, 8), axis=1, bitorder="little")
            k, bit = np.nonzero(near)
            yield int(rows[row[s]]), block[s:e][k] * 64 + bit


def local_stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected within the radius: each fingerprint to the first of its group."""
    group = np.arange(len(fps))
    for i, lanes in near_lanes(fps, radius):
        met = np.unique(group[np.r_[i, lanes]])
        if len(met) > 1:
            group[np.isin(group, met)] = met[0]
    at = np.flatnonzero(group != np.arange(len(fps)))
    return fps[at], fps[group[at]]


def bucket_keys(radius: int, parts: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """The choices of parts that must agree: (table, [(first bit, bits)]). With `parts` parts and at most `radius`
    differing bits, parts - radius of them agree."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [(t, [(cuts[i], cuts[i + 1] - cuts[i]) for i in c]) for t, c in enumerate(combinations(range(parts), parts - radius))]


def linked(fps: DataFrame, radius: int = RADIUS, parts: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) links among distinct fingerprints (column fp) that connect all that are within the radius, at most one
    a fingerprint and bucket. A bucket of over bucket_rows rows is cut into parts and each pair of parts is compared
    in a task of its own, so no bucket is too large and none is cut off."""
    parts = parts or radius + 2
    keys = []
    for t, fields in bucket_keys(radius, parts):
        key, room = F.lit(t).cast("long"), 0
        for first, n in fields:
            key = F.shiftleft(key, n).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << n) - 1)))
            room += n
        keys.append(key)
    all_keys = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = all_keys.groupBy("key").count().where(F.col("count") > bucket_rows).select("key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("cut"))
    cut = F.coalesce(F.col("cut"), F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), cut).cast("int")
    other = F.sequence(F.lit(0), cut - 1)
    dealt = (
        all_keys.join(large, "key", "left").select("fp", "key", mine.alias("mine"), F.explode(other).alias("other"))
        .select("fp", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    )
    order = ["key", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(fp: np.ndarray) -> pa.RecordBatch:
            a, b = local_stars(np.unique(fp), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        kept: list[np.ndarray] = []
        size = 0
        rest = [np.zeros(0, np.int64)] * 4
        for b in batches:
            cols = [np.r_[r, b[c].to_numpy().astype(np.int64)] for r, c in zip(rest, [*order, "fp"], strict=True)]
            if not len(cols[3]):
                continue
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            starts = np.r_[0, new]
            last = starts[-1]
            for s, e in zip(starts[:-1], new, strict=True):
                if e - s > 1:
                    kept.append(cols[3][s:e])
                    size += e - s
                    if size >= LANES:
                        yield out(np.concatenate(kept))
                        kept, size = [], 0
            rest = [c[last:] for c in cols]
        if len(rest[3]) > 1:
            kept.append(rest[3])
        if kept:
            yield out(np.concatenate(kept))

    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(frugal(compare), "a long, b long")


def groups(fps: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """fp, root, component_id for each distinct fingerprint of (doc_id, fp): the least doc_id of all documents that
    chains of links reach."""
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    return rooted(distinct, linked(distinct, radius, bucket_rows=bucket_rows))


def rooted(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """fp, root and component_id for each of distinct (fp, first_id), linked by (a, b)."""
    roots = components(links)
    found = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return found.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row.

    Null and empty texts, and texts of white space, have fingerprint 0 and link like others. Equal texts meet as one
    fingerprint, so a group of any size costs one. Null ids get the id of their group, or null where it has none.
    Repeated rows are returned as often as they occur, an empty table gives none, other columns are ignored."""
    fps = staged(fingerprints(docs))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(groups(fps, radius, bucket_rows), "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of docs without near duplicates: of each group the row with the least doc_id stays, once; of several rows
    of that id and fingerprint the least by text, lang, source and n_chars. A group of null ids only keeps one row."""
    fps = staged(fingerprints(docs))
    return least_rows(docs, fps, groups(fps, radius), fingerprint)


def least_rows(docs: DataFrame, fps: DataFrame, grouped: DataFrame, fingerprint: Callable[[str | None], int]) -> DataFrame:
    """Of each group (fp, root, component_id) the row of docs with the least doc_id, once; fps has doc_id and fp of each row."""
    found = staged(fps.join(grouped, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fp", "root"))
    docs = pick(docs, *COLUMNS)
    unclear = fps.where(F.col("doc_id").isNull()).limit(1).union(fps.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(0).cast("long")).limit(1))
    if not unclear.take(1):
        return docs.join(found.select("doc_id"), "doc_id", "left_semi").select(*COLUMNS)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b["text"]), np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*b.schema.names, "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    own = docs.mapInArrow(frugal(marked), f"{kinds}, fp long")
    keep = found.distinct().withColumnRenamed("doc_id", "kept_id").withColumnRenamed("fp", "kept_fp")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp"))
    least = own.join(keep, same).groupBy("root").agg(F.min(F.struct("text", "lang", "source", "n_chars", "doc_id")).alias("r"))
    return least.select("r.*").select(*COLUMNS)

"""SimHash near-dedup at the similarity of 0.8 that a stage asks for, on five-word shingles.

At that similarity 256-bit fingerprints differ in about 40 to 50 bits, so no choice of parts has to agree and SimHash
alone can't give the buckets: MinHash bands do (sets of similarity 0.8 share at least one of 30 bands of five minima with
probability 0.99999). What chains of bands reach is sent to a task once; there bit-sliced comparison of the fingerprints
finds the pairs within 96 bits, and an exact check of the Jaccard similarity on the whole sets keeps those of 0.8 or more."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm import simhash
from simlane.llm.common import frugal, pick, staged
from simlane.llm.components import components
from simlane.llm.lm_score import ngrams

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 30, 5
#: 64-bit words of a fingerprint, and the bits in which two may differ: sets of similarity 0.8 differ in 39 on the mean
#: (51 if tiny) with a deviation of 6, unrelated ones in 128 with one of 8.
WORDS, RADIUS = 4, 96
#: Texts hashed together, and shingles whose minima are taken at once.
TEXTS, SHINGLES = 64, 4096
#: Sets up to which the table of their names (two numbers each) is broadcast: 16 MB.
BROADCAST_SETS = 1_000_000
#: Sets that a task compares at once, twice as many at most for a pair of parts.
PART_ROWS = 256
_r = np.random.default_rng(42)
_MUL = (_r.integers(0, 2**31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _r.integers(0, 2**32, BANDS * ROWS, np.uint32)[:, None]
_MIX = _r.integers(0, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _r.integers(0, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each whole text (words with A-Z lower-cased, split at ASCII white
    space). Fewer words than a shingle: one of all; none or null: no hash."""
    out = []
    for lo in range(0, len(texts), TEXTS):
        part = texts[lo : lo + TEXTS]
        doc, grams = ngrams(part, shingle)
        ends = np.searchsorted(doc, np.arange(len(part) + 1))
        for s, e in zip(ends[:-1], ends[1:], strict=True):
            k = min(shingle, int(e - s))
            out.append(np.unique(grams[k - 1][s + k - 1 : e]) if k else np.zeros(0, np.uint64))
    return out


def set_hash(hashes: np.ndarray) -> int:
    """One number for a set; 0 for the empty one."""
    return xxhash.xxh64_intdigest(hashes.tobytes()) if len(hashes) else 0


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key a band, from the minima of the set under ROWS permutations; none for the empty set."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), SHINGLES):
        low = np.minimum(low, (short[None, lo : lo + SHINGLES] * _MUL + _ADD).min(axis=1))
    key = ((low.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * _MIX).sum(axis=1, dtype=np.uint64)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.arange(BANDS, dtype=np.uint64)
    return key ^ (key >> np.uint64(32))


def fingerprint(hashes: np.ndarray) -> bytes:
    """256-bit SimHash of a set: a bit is 1 if it is set in over half of the shingles' mixed hashes."""
    count = np.zeros(64 * WORDS, np.int64)
    for lo in range(0, len(hashes), SHINGLES):
        h = hashes[lo : lo + SHINGLES, None] * _WORD[None, :]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        count += np.unpackbits((h ^ (h >> np.uint64(31))).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * count > len(hashes), bitorder="little").tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the hash of the shingle set as a signed long), band keys and fingerprint of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b["text"].to_pylist())
            fps = np.fromiter(map(set_hash, sets), np.uint64, len(sets)).view(np.int64)
            keys = pa.array([band_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            wide = pa.array([fingerprint(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(fps), keys, wide], names=["doc_id", "fp", "keys", "wide"])

    return pick(docs, "doc_id", "text").mapInArrow(frugal(run), "doc_id long, fp long, keys array<long>, wide binary")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """fp and the whole shingle set, once for each of wanted (fp, first_id), from the rows of that id. Up to
    BROADCAST_SETS of them are broadcast, so that sets that nobody asks for aren't shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b["text"].to_pylist())
            found = np.fromiter(map(set_hash, sets), np.uint64, len(sets)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(found), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "fp", "shingles"])

    every = pick(docs, "doc_id", "text").mapInArrow(frugal(run), "doc_id long, fp long, shingles binary")
    wanted = wanted.select(F.col("fp").alias("wanted"), "first_id")
    wanted = F.broadcast(wanted) if wanted.limit(BROADCAST_SETS + 1).count() <= BROADCAST_SETS else wanted
    own = (F.col("fp") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return every.join(wanted, own, "left_semi").select("fp", "shingles").dropDuplicates(["fp"])


def local_links(fps: np.ndarray, wide: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what pairs of the similarity connect: each set to the first of its group. wide: fingerprints, a
    row of WORDS a set."""
    group = np.arange(len(fps))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    for i, lanes in simhash.near_lanes(wide, RADIUS):
        other = lanes[(np.minimum(sizes[lanes], sizes[i]) >= SIMILARITY * np.maximum(sizes[lanes], sizes[i])) & (group[lanes] != group[i])]
        if not len(other):
            continue
        mine, theirs = sets[i], np.concatenate([sets[k] for k in other])
        hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        both = np.add.reduceat(hit, np.r_[0, np.cumsum(sizes[other])[:-1]], dtype=np.int64)
        near = other[both >= SIMILARITY * (sizes[i] + sizes[other] - both)]
        if len(near):
            met = np.unique(group[np.r_[i, near]])
            group[np.isin(group, met)] = met[0]
    at = np.flatnonzero(group != np.arange(len(fps)))
    return fps[at], fps[group[at]]


def links(docs: DataFrame, distinct: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(a, b) links among distinct sets (fp, first_id, keys, wide) that connect all pairs of a common band and of the similarity.
    What chains of bands reach is compared in one task or, over part_rows sets, in one for each pair of parts."""
    every = distinct.select("fp", F.explode("keys").alias("key"))
    first = every.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("key", "b")
    cloud = staged(components(every.join(first, "key").select(F.col("fp").alias("a"), "b")).select(F.col("node").alias("fp"), F.col("root").alias("cloud")))
    named = staged(cloud.join(distinct.select("fp", "first_id", "wide"), "fp"))
    cut = F.ceil(F.count("*") / part_rows).cast("int").alias("cut")
    mine = F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int")
    dealt = (
        named.join(cloud.groupBy("cloud").agg(cut), "cloud").join(sets_of(docs, named.select("fp", "first_id")), "fp")
        .select("fp", "wide", "shingles", "cloud", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("other"))
        .select("fp", "wide", "shingles", "cloud", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    )

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        wide = np.frombuffer(b"".join(t["wide"].to_pylist()), np.uint64).reshape(-1, WORDS)
        a, b = local_links(t["fp"].to_numpy(), wide, [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()])
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("cloud", "lo", "hi").applyInArrow(compare, "a long, b long")


def groups(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """fp, root, component_id for each distinct set of the sketches: the least doc_id of all that chains of links reach."""
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.first("keys").alias("keys"), F.first("wide").alias("wide")))
    return simhash.rooted(distinct.select("fp", "first_id"), links(docs, distinct))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs without near copies: of each group the row with the least doc_id stays, once. Null texts and
    texts without words are one group; repeated rows stay once; of several rows of the kept id and shingle set that with
    the least text, lang, source and n_chars stays; a group of null ids only keeps one row. Other columns are dropped,
    an empty table gives no rows."""
    rows = staged(sketches(docs))
    return simhash.least_rows(docs, rows.select("doc_id", "fp"), groups(docs, rows), lambda text: set_hash(shingle_sets([text])[0]))

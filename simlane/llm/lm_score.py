"""Stupid-backoff language-model scores: n-gram count tables partitioned by hash, joined to the documents' exploded
n-grams and summed per document.

Documents are dealt into chunks of bounded size. A chunk's n-grams are exploded and pre-aggregated; they travel sorted and
packed, (part, chunk, n-grams, counts), to the part of the hash's range that their upper bits name. There the count table of
the part is the sum over its rows by n-gram, and the rows are joined to it by n-gram; table and rows lie in the same
part, so one exchange serves both. The counts go back to the chunks in the n-grams' order, and each chunk adds up the
scores of its documents. An n-gram that every document has costs an entry a chunk, and parts are even whatever the
words' frequencies are. layout() keeps the rows' number in proportion to the corpus."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import frugal, pick, release, slices

ORDER, ALPHA = 3, 0.4
#: Tokens of a chunk and n-grams of a part of the hash's range, least and most; a task holds about 100 bytes a token of a
#: chunk and 30 an n-gram of a part.
CHUNK_TOKENS, PART_ENTRIES = (1_400_000, 12_000_000), (1_000_000, 16_000_000)
#: Upper bits of a hash that name its part, at least, and bits up to which parts grow in number before they grow in size.
LEAST_BITS, EVEN_BITS = 6, 16
#: Bytes of the texts that are dealt together.
PAGE_BYTES = 1 << 18
#: Characters of a text that are split into words at once, words remembered with their hashes, and the longest that are.
SLICE, KNOWN_WORDS, KNOWN_BYTES = 1_000_000, 300_000, 64
#: What a word that no other document has counts as.
UNSEEN = 0.5


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word) or 1
        if len(word) <= KNOWN_BYTES:
            self[word] = h
        return h


def word_hashes(text: str | None, known: _Words) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased, split at ASCII white space) of the whole text, a slice at a time."""
    parts = []
    for part in slices((text or "").encode("utf-8", "surrogatepass").lower(), SLICE):
        words = part.split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def ngrams(texts: Iterable[str | None], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The document of each word, and for k = 1 .. order the hash of the k-gram that ends at it (0: there is none)."""
    known = _Words()
    words = [word_hashes(t, known) for t in texts]
    doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
    one = np.concatenate(words) if words else np.zeros(0, np.uint64)
    grams = [one]
    for k in range(2, order + 1):
        h = np.zeros(len(one), np.uint64)
        if len(one) >= k:
            last = grams[-1]
            # the (k-1)-gram that ends a word earlier, then this word
            mixed = (last[:-1] ^ (last[:-1] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            h[1:] = np.maximum(mixed, np.uint64(1))
            h[1:][(last[:-1] == 0) | (doc[1:] != doc[:-1])] = 0
        grams.append(h)
    return doc, grams


def ordered(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of all n-grams (order by order, those of a word that has none left out) in the order of their hashes as
    signed numbers, equal ones by place; and these hashes."""
    every = np.concatenate(grams).view(np.int64)
    at = np.flatnonzero(every) if every.size and not every.all() else np.arange(len(every))
    at = at[np.argsort(every[at], kind="stable")]
    return at, every[at]


def distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams as signed numbers in order, with their counts; among them the entry 0, which counts the words."""
    h = np.sort(np.concatenate([np.zeros(1, np.int64), *(g[g != 0].view(np.int64) for g in grams)]))
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    counts = np.diff(np.r_[first, len(h)])
    hashes = h[first]
    counts[np.searchsorted(hashes, 0)] = len(grams[0])
    return hashes, counts


def backoff(doc: np.ndarray, grams: list[np.ndarray], counts: np.ndarray, n_docs: int, alpha: float, own: bool) -> np.ndarray:
    """Sum of log scores of each document; counts are those of the entries of distinct(), in their order. own: the
    document's own n-grams are not counted."""
    m = len(doc)
    if not m:
        return np.zeros(n_docs)
    at, h = ordered(grams)
    new = np.r_[True, h[1:] != h[:-1]]
    entry = np.cumsum(new) - 1
    zero = int(np.searchsorted(h[new], 0))  # where the entry that counts the words lies
    entry += entry >= zero
    seen = np.zeros(len(grams) * m)
    seen[at] = counts[entry]
    if own:
        # equal n-grams follow each other by order and document, and no n-gram has two orders
        first = np.flatnonzero(new | np.r_[True, doc[at[1:] % m] != doc[at[:-1] % m]])
        mine = np.diff(np.r_[first, len(h)])
        seen[at] -= np.repeat(mine, mine)
    words = np.bincount(doc, minlength=n_docs)
    every = float(counts[zero])
    total = np.maximum(1.0, every - words)[doc] if own else np.full(m, max(1.0, every))
    by = seen.reshape(len(grams), m)
    score = np.log(np.maximum(by[0], UNSEEN) / total)
    for k in range(1, len(grams)):
        context = np.r_[1.0, by[k - 1][:-1]]
        hit = by[k] > 0
        higher = np.log(np.where(hit, by[k], 1.0) / np.where(hit, context, 1.0))
        score = np.where(hit, higher, np.where(grams[k] != 0, np.log(alpha) + score, score))
    return np.bincount(doc, score, minlength=n_docs)


def layout(words: int, order: int, chunk_tokens: int | None = None, part_entries: int | None = None) -> tuple[int, int]:
    """Chunks and the bits that name a part, for so many words. Parts grow in number first, then in size and chunks with
    them, so that a row of a chunk and a part keeps at least about three n-grams and rows don't outgrow n-grams."""
    total = max(1, words * order)
    most = part_entries or min(PART_ENTRIES[1], max(PART_ENTRIES[0], total >> EVEN_BITS))
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(1.0, total / most)))))
    size = chunk_tokens or min(CHUNK_TOKENS[1], max(CHUNK_TOKENS[0], 2 << bits))
    return max(1, -(-words // size)), bits


def paged(docs: DataFrame, chunks: int, asks: bool) -> DataFrame:
    """The documents in pages, each dealt to a chunk (below zero where it isn't asked for) by its place in the input, so
    that equal rows don't meet in one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        write = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        at, seq = TaskContext.get().partitionId(), 0

        def page(rows: pa.RecordBatch) -> pa.RecordBatch:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rows.schema, options=write) as w:
                w.write_batch(rows)
            to = xxhash.xxh64_intdigest(f"{at}:{seq}") % chunks
            return pa.RecordBatch.from_arrays([pa.array([to if asks else -1 - to], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["chunk", "page"])

        for b in batches:
            size = np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in b["text"].cast(pa.large_binary())])
            cuts = [0, *(np.flatnonzero(np.diff(size // PAGE_BYTES)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi > lo:
                    yield page(b.slice(lo, hi - lo))
                    seq += 1

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(run), "chunk long, page binary")


def _opened(pages: pa.Table) -> Iterator[pa.Table]:
    return (pa.ipc.open_stream(x.as_buffer()).read_all() for x in pages["page"])


def _texts(pages: pa.Table) -> Iterator[str | None]:
    return (t.as_py() for page in _opened(pages) for t in page["text"])


def _packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes in planes, so that upper ones compress away."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(np.asarray(values, np.int64).view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(np.int64)


def exploded(pages: DataFrame, order: int, bits: int) -> DataFrame:
    """(part, chunk, grams, ns): the distinct n-grams of each chunk, sorted, with their counts, both packed; a row for
    each part of the hash's range."""

    def run(t: pa.Table) -> pa.Table:
        _, grams = ngrams(_texts(t), order)
        hashes, counts = distinct(grams)
        del grams
        release()
        part = (hashes >> np.int64(64 - bits)) + (1 << (bits - 1))
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(hashes)]
        ends = list(zip(cuts[:-1], cuts[1:], strict=True))
        differences = [_packed(np.diff(hashes[s:e], prepend=np.int64(0))) for s, e in ends]
        return pa.table({"part": pa.array(part[cuts[:-1]].astype(np.int32)), "chunk": pa.array(np.full(len(ends), t["chunk"][0].as_py(), np.int64)), "grams": pa.array(differences, pa.binary()), "ns": pa.array([_packed(counts[s:e]) for s, e in ends], pa.binary())})

    return pages.groupBy("chunk").applyInArrow(run, "part int, chunk long, grams binary, ns binary")


def _table(t: pa.Table, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The count table of a part's rows (n-grams and totals), the entry of each of the rows' n-grams in it, in the order
    of `order`, and the rows' sizes."""
    grams = [np.cumsum(_unpacked(x)) for x in t["grams"].to_pylist()]
    ns = np.concatenate([_unpacked(x) if own or c < 0 else np.zeros(len(g), np.int64) for x, c, g in zip(t["ns"].to_pylist(), t["chunk"].to_pylist(), grams, strict=True)])
    sizes = [len(g) for g in grams]
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    new = np.r_[True, np.diff(every[order]) != 0]
    return every[order][new], np.add.reduceat(ns[order], np.flatnonzero(new)), np.cumsum(new) - 1, order, sizes


def count_table(rows: DataFrame, own: bool = True) -> DataFrame:
    """(part, gram, total): the n-gram count table of the rows of exploded(), partitioned by hash."""

    def run(t: pa.Table) -> pa.Table:
        gram, total, *_ = _table(t, own)
        return pa.table({"part": pa.array(np.full(len(gram), t["part"][0].as_py(), np.int32)), "gram": pa.array(gram), "total": pa.array(total)})

    return rows.groupBy("part").applyInArrow(run, "part int, gram long, total long")


def with_totals(rows: DataFrame, own: bool) -> DataFrame:
    """(chunk, part, totals): the rows of exploded() that ask, joined by n-gram to the count table of all rows (own) or of
    those that don't ask; totals are packed and in the n-grams' order."""

    def run(t: pa.Table) -> pa.Table:
        _, total, entry, order, sizes = _table(t, own)
        joined = np.empty(len(order), np.int64)
        joined[order] = total[entry]
        ends = np.cumsum(sizes)
        chunk = t["chunk"].to_pylist()
        asks = [i for i, c in enumerate(chunk) if c >= 0]
        blobs = [_packed(joined[ends[i] - sizes[i] : ends[i]]) for i in asks]
        return pa.table({"chunk": pa.array([chunk[i] for i in asks], pa.int64()), "part": pa.array([t["part"][0].as_py()] * len(asks), pa.int32()), "totals": pa.array(blobs, pa.binary())})

    return rows.groupBy("part").applyInArrow(run, "chunk long, part int, totals binary")


def scores(docs: DataFrame, reference: DataFrame | None = None, order: int = ORDER, alpha: float = ALPHA, chunk_tokens: int | None = None, part_entries: int | None = None) -> DataFrame:
    """doc_id, n_words, log_score (sum over words of log S) and score (its mean, null without words) of each row.

    S(w | context) = c(context w) / c(context) where that n-gram is counted, else alpha x S(w | shorter context); the
    last is c(w) / (all words), a word not counted standing for UNSEEN of one. A document's first words have shorter
    contexts, without alpha. Counts are over all of reference or, where it is None, over all other documents of docs:
    a document's own n-grams are taken off, else each rare n-gram would vouch for itself.

    Null and empty texts have no words and log_score 0; repeated rows count as documents of their own, in any number;
    null ids are kept; other columns are ignored; an empty table gives no rows. The inputs are read as the files have
    them: pages are dealt by their place, which must be the same if a task runs again."""
    own = reference is None
    sides = [(docs, True)] + ([] if own else [(reference, False)])
    size = sum(int(pick(d, "text").agg(F.sum(F.length("text"))).first()[0] or 0) for d, _ in sides) // 6 + 1
    chunks, bits = layout(size, order, chunk_tokens, part_entries)

    def summed(pages: pa.Table, found: pa.Table) -> pa.Table:
        doc, grams = ngrams(_texts(pages), order)
        by = sorted(zip(found["part"].to_pylist(), found["totals"].to_pylist(), strict=True))
        counts = np.concatenate([_unpacked(x) for _, x in by] or [np.zeros(1, np.int64)])
        ids = pa.chunked_array([c for page in _opened(pages) for c in page["doc_id"].chunks], pa.int64())
        n = len(ids)
        total = backoff(doc, grams, counts, n, alpha, own)
        words = np.bincount(doc, minlength=n).astype(np.int64)
        del doc, grams, counts
        release()
        mean = pa.array(total / np.maximum(1, words), mask=words == 0)
        return pa.table({"doc_id": ids, "n_words": pa.array(words), "log_score": pa.array(total), "score": mean})

    asking = paged(docs, chunks, True)
    pages = asking if own else asking.unionByName(paged(reference, chunks, False))
    back = with_totals(exploded(pages, order, bits), own)
    return asking.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(summed, "doc_id long, n_words long, log_score double, score double")


ORACLE = """WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT r, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM t),
g AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS u FROM x),
c1 AS (SELECT w, count(*) AS n FROM g GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY v, w),
c3 AS (SELECT u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY u, v, w),
o1 AS (SELECT r, w, count(*) AS n FROM g GROUP BY r, w),
o2 AS (SELECT r, v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY r, v, w),
o3 AS (SELECT r, u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY r, u, v, w),
a1 AS (SELECT o1.r, o1.w, c1.n - o1.n AS n, greatest(1, (SELECT count(*) FROM g) - len(t.w)) AS total FROM o1 JOIN c1 USING (w) JOIN t USING (r)),
a2 AS (SELECT o2.r, o2.v, o2.w, c2.n - o2.n AS n FROM o2 JOIN c2 USING (v, w)),
a3 AS (SELECT o3.r, o3.u, o3.v, o3.w, c3.n - o3.n AS n FROM o3 JOIN c3 USING (u, v, w)),
s AS (
  SELECT g.r, CASE WHEN a3.n > 0 THEN ln(a3.n / uv.n)
    WHEN a2.n > 0 THEN CASE WHEN g.u IS NOT NULL THEN ln(0.4) ELSE 0 END + ln(a2.n / v1.n)
    ELSE CASE WHEN g.u IS NOT NULL THEN 2 * ln(0.4) WHEN g.v IS NOT NULL THEN ln(0.4) ELSE 0 END + ln(greatest(a1.n, 0.5) / a1.total) END AS s
  FROM g JOIN a1 ON a1.r = g.r AND a1.w = g.w LEFT JOIN a1 v1 ON v1.r = g.r AND v1.w = g.v LEFT JOIN a2 ON a2.r = g.r AND a2.v = g.v AND a2.w = g.w
    LEFT JOIN a2 uv ON uv.r = g.r AND uv.v = g.u AND uv.w = g.v LEFT JOIN a3 ON a3.r = g.r AND a3.u = g.u AND a3.v = g.v AND a3.w = g.w),
z AS (SELECT r, sum(s) AS s FROM s GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(z.s, 0), 3) AS log_score, round(z.s / len(w), 6) AS score FROM t LEFT JOIN z USING (r)"""

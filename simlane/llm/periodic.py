"""Periodic runs of words by Crochemore's partition refinement.

Positions of a text are in one class at length l if the l words from there on are equal. Classes at l + 1 come from those
at l by splitting them by the class of the next position; only classes that the last step split off count as splitters,
all parts of a class but its largest (the smaller half), so a position is moved once for each halving of its class. The
members of a class are linked in the order of the text: neighbours at distance l show a square of period l, which has no
smaller period, as its root would else occur between them. A run of period q that is three periods long has squares at q places
in a row, so at length q every q-th place is looked at; squares of one run are merged by extending the first.

A run holds each of its words three times, so rarer words of a document cut it into stretches, and only those as long as
a run are refined (stretches). Those of many documents are packed together, each with words and an end mark of its own: classes
never span stretches, and a step of the refinement is a few array operations for all of them."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from simlane.llm.common import frugal, pick

#: Words of the documents that are refined together; a longer document is refined alone.
BATCH_WORDS = 1 << 19
#: Least length of a run, and least number of its periods.
LEAST, PERIODS = 24, 3
REPORT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def begins(changed: np.ndarray) -> np.ndarray:
    """Indices where a group begins, from whether each element but the first differs from the one before it."""
    first = np.empty(len(changed) + 1, bool)
    first[0] = True
    first[1:] = changed
    return first.nonzero()[0]


def lengths(first: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the groups of n elements that begin at first."""
    out = np.empty(len(first), np.int64)
    out[:-1] = first[1:]
    out[-1] = n
    out -= first
    return out


class Classes:
    """Classes of equal factors: cls by place; members of class c in perm[start[c] : start[c] + size[c]], at[i] being
    the index of place i there; ahead and back link a class's members in text order (the value n: none)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = n
        self.cls = np.unique(words, return_inverse=True)[1].astype(np.int32)
        self.perm = np.argsort(self.cls, kind="stable").astype(np.int32)
        self.size = np.zeros(n + 1, np.int32)
        self.start = np.zeros(n + 1, np.int32)
        sizes = np.bincount(self.cls) if n else np.zeros(0, np.int64)
        self.size[: len(sizes)] = sizes
        self.start[: len(sizes)] = np.cumsum(sizes) - sizes
        self.count = len(sizes)
        self.at = np.empty(n, np.int32)
        self.at[self.perm] = np.arange(n, dtype=np.int32)
        self.ahead = np.full(n + 1, n, np.int32)
        self.back = np.full(n + 1, n, np.int32)
        self._link(self.perm, self.cls[self.perm])
        largest = int(self.size[: self.count].argmax()) if self.count else -1
        #: Places of the classes that split the others next, in order.
        self.small = np.flatnonzero(self.cls != largest)

    def _link(self, places: np.ndarray, group: np.ndarray) -> None:
        """Links places, in order within their group; group's values are equal side by side."""
        if not len(places):
            return
        same = group[1:] == group[:-1]
        self.ahead[places[:-1]] = np.where(same, places[1:], self.n)
        self.ahead[places[-1]] = self.n
        self.back[places[1:]] = np.where(same, places[:-1], self.n)
        self.back[places[0]] = self.n

    def refine(self, live: np.ndarray, length: int) -> None:
        """From classes at length to those at length + 1; places whose live value is not above length stay behind."""
        k = self.small - 1
        k = k[1:] if len(k) and k[0] < 0 else k
        k = k[(live[k] > length) & (self.size[self.cls[k]] > 1)]
        if not len(k):
            self.small = k
            return
        parent = self.cls[k]
        order = np.argsort(parent.astype(np.int64) * (self.n + 1) + self.cls[k + 1], kind="stable")
        k, parent, by = k[order], parent[order], self.cls[k + 1][order]
        # parts of a class by the class of the next place, and what of it isn't touched
        first = begins((parent[1:] != parent[:-1]) | (by[1:] != by[:-1]))
        part = lengths(first, len(k))
        of = parent[first]
        head = begins(of[1:] != of[:-1])
        parts = lengths(head, len(of))
        owner = of[head]
        rest = self.size[owner] - np.add.reduceat(part, head)
        which = np.repeat(np.arange(len(owner)), parts)
        # the first of the largest touched parts of each class
        ranked = np.lexsort((-part, which))
        largest = ranked[head]
        biggest = part[largest]
        # a class that is touched whole keeps its largest part; else it keeps what isn't touched
        moves = np.ones(len(of), bool)
        moves[largest[rest == 0]] = False
        # of all parts the largest splits nothing: what is kept, unless a moved part is larger
        splits = moves.copy()
        outgrown = (rest > 0) & (biggest > rest)
        splits[largest[outgrown]] = False
        moved = np.repeat(moves, part)
        gone = k[moved]
        if not len(gone):
            self.small = gone
            return
        self._unlink(gone, parent[moved])
        n_new = int(moves.sum())
        new = np.arange(self.count, self.count + n_new, dtype=np.int32)
        sizes = part[moves]
        mine = np.repeat(new, sizes)
        self._link(gone, mine)
        self._store(gone, which[moves], owner, sizes, new)
        self.cls[gone] = mine
        self.count += n_new
        left = owner[outgrown]
        places = [k[np.repeat(splits, part)]]
        if len(left):
            places.append(self.perm[np.repeat(self.start[left] - np.cumsum(self.size[left]) + self.size[left], self.size[left]) + np.arange(self.size[left].sum())])
        self.small = np.sort(np.concatenate(places))

    def _unlink(self, gone: np.ndarray, parent: np.ndarray) -> None:
        """Takes places out of their classes' links; neighbours that leave together are bridged at once."""
        m = gone[np.lexsort((gone, parent))]
        chain = begins(self.ahead[m[:-1]] != m[1:])
        before, behind = self.back[m[chain]], self.ahead[m[chain + lengths(chain, len(m)) - 1]]
        self.ahead[before] = behind
        self.back[behind] = before

    def _store(self, gone: np.ndarray, which: np.ndarray, owner: np.ndarray, sizes: np.ndarray, new: np.ndarray) -> None:
        """Gives moved parts the last slots of their class; members that stay take the slots that become free."""
        leaving = np.bincount(which, sizes, len(owner)).astype(np.int64)
        kept = self.size[owner] - leaving
        begin = self.start[owner] + kept
        tail = np.repeat(begin - np.cumsum(leaving) + leaving, leaving) + np.arange(len(gone))
        away = self.at[gone] < np.repeat(begin, leaving)
        free = self.at[gone][away]
        inside = self.perm[tail]
        self.at[gone] = -1
        stay = inside[self.at[inside] >= 0]
        self.perm[free] = stay
        self.at[stay] = free
        self.perm[tail] = gone
        self.at[gone] = tail
        self.size[owner] = kept
        self.size[new] = sizes
        self.start[new] = tail[np.cumsum(sizes) - sizes]


def matching(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays, looked at in growing pieces."""
    most, done, step = min(len(a), len(b)), 0, 64
    while done < most:
        end = min(most, done + step)
        differ = np.flatnonzero(a[done:end] != b[done:end])
        if len(differ):
            return done + int(differ[0])
        done, step = end, 2 * step
    return most


def runs(words: np.ndarray, live: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal stretches with smallest period q, at least max(least, periods * q) long
    (periods at least 3). words are numbers, with one of its own at each document's end; live has for each place the
    longest period of its document, 0 for places that are left out."""
    classes, out = Classes(words), []
    for q in range(1, int(live.max(initial=0)) + 1):
        if q > 1:
            classes.refine(live, q - 1)
        if not len(classes.small) and q > 1:
            break
        places = np.arange(0, len(words), q, dtype=np.int32)
        done = 0
        for i in places[classes.ahead[places] == places + q].tolist():
            if i < done or live[i] < q:
                continue
            right = matching(words[i:], words[i + q :])
            left = matching(words[:i][::-1], words[q : i + q][::-1])
            done = i + right
            if left + right + q >= max(least, periods * q):
                out.append((i - left, left + right + q, q))
    return out


def perturbed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the id's checksum plants in every tenth document; none without an id."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def described(doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """A row of REPORT from the runs of a document (start, length, period), sorted."""
    keep = np.zeros(len(words) + 1, np.int64)
    best: tuple[int | None, ...] = (None,) * 4
    for start, length, q in found:
        keep[start + q] += 1
        keep[start + length] -= 1
        if best[0] is None or length * best[2] > best[1] * q:
            best = (start, length, q, 1000 * length // q)
    text = b" ".join([w for w, d in zip(words, np.cumsum(keep), strict=False) if not d] if found else words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return doc_id, len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest()


def stretches(number: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> Iterator[tuple[int, int]]:
    """(begin, end) of the stretches of a document's words in which each word occurs often enough in the document, if they
    are as long as a run. A run holds each of its words at least `periods` times, so no run lies outside or reaches further."""
    rare = np.ones(len(number) + 2, bool)
    rare[1:-1] = np.bincount(number)[number] < periods
    edge = np.flatnonzero(rare)
    for i in np.flatnonzero(np.diff(edge) > least).tolist():
        yield int(edge[i]), int(edge[i + 1]) - 1


def documents_runs(docs: list[tuple[int | None, list[bytes]]]) -> Iterator[tuple]:
    """Rows of REPORT for documents that are refined together."""
    parts, live, origin, n, known = [], [], [], 0, 0
    for d, (_, words) in enumerate(docs):
        if len(words) < LEAST:
            continue
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        for begin, end in stretches(ids):
            parts += [ids[begin:end] + known, [known + len(numbers)]]
            known += len(numbers) + 1
            live.append(np.full(end - begin + 1, (end - begin) // PERIODS, np.int32))
            origin.append((n, d, begin))
            n += end - begin + 1
    own: dict[int, list] = defaultdict(list)
    if parts:
        starts = np.array([o[0] for o in origin])
        for s, length, q in runs(np.concatenate(parts), np.concatenate(live)):
            at, d, begin = origin[int(np.searchsorted(starts, s, "right")) - 1]
            own[d].append((s - at + begin, length, q))
    for d, (doc_id, words) in enumerate(docs):
        yield described(doc_id, words, sorted(own[d], key=lambda r: (r[0], r[2])) if d in own else [])


def report(batches: Iterator[pa.RecordBatch], plant: bool, most: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int | None, list[bytes]]] = []
    n = 0
    schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (c.split() for c in REPORT.split(", "))])

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*documents_runs(held), strict=True), schema.types, strict=True)], schema=schema)

    for b in batches:
        texts = b.column("text").cast(pa.large_binary())
        for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
            words = (texts[i].as_py() or b"").split()  # of bytes: at exactly the six ASCII white-space characters
            held.append((doc_id, perturbed(doc_id, words) if plant else words))
            n += len(words)
            if n >= most:
                yield out()
                held, n = [], 0
    if held:
        yield out()


def periodic_runs(documents: DataFrame, plant: bool = False, batch_words: int = BATCH_WORDS) -> DataFrame:
    """One row a row of documents (doc_id, text), in REPORT's columns: n_runs, the run of greatest exponent (ties: the
    smallest start, then period), its exponent in thousandths rounded down, the SHA-256 of all runs' lines
    'start,length,period' by start and period, and that of the words that no run covers behind its first period, joined
    by spaces. plant puts a repetition into every tenth document first, as the id's checksum tells (perturbed).

    Words are what ASCII white space separates. Null and empty texts have no word and no run, and the SHA-256 of nothing
    twice; a null id plants nothing; repeated rows are reported each; documents of fewer than 24 words have no run; an
    empty table gives no rows; other columns are ignored. A task holds a batch of documents of about batch_words words, or one
    longer document: about 150 bytes a word. Documents are independent, so a lost task is done again by itself."""
    run = frugal(lambda batches: report(batches, plant, batch_words))
    return pick(documents, "doc_id", "text").mapInArrow(run, REPORT)

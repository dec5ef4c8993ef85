"""Periodic runs of words, found by online dyadic square catching, and texts collapsed to one period of each run.

Words are appended to a buffer; whenever a power-of-two block of ``size`` words is complete, a catcher is set on it. The
catcher lives while the next block is appended: each appended word advances the comparison of the suffix of ``size``
words that it ends with the catcher's block. Equal fingerprints at distance q (size <= q < 2 * size) report a square
in the making. Reports of neighbouring catchers at one distance merge, are extended word by word to both sides (by the
words themselves, not by fingerprints), and give one maximal repetition.

Why nothing is missed: a run of period q has at least 3 * q words (and 24), so with ``size`` the largest power of two
up to q (8 for shorter periods) it holds a complete block whose copy at distance q lies in the run too. Reports inside of a known repetition whose
period divides q are dropped: the whole stretch then has that smaller period. Fingerprints are equal for equal words, so a
collision can only cost time.

The words of many texts go through one buffer, long texts first, with a separator of its own after each text. The lanes
of one level are compared at once, in slices of bounded size, so a level costs a few passes over the words of those
texts that are long enough for its periods. Spark deals the texts; nothing is shuffled. A text's memory is a few
machine words per word.

Edge cases: null text has no words; a null id repeats nothing (its text is taken as it is); equal rows give equal rows;
texts without a run have four nulls and the digest of no runs; only the two given columns are read, so further
columns, whatever their names, don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 24
LEAST_PERIODS = 3
FIRST_SIZE = 8  # blocks below this size need no catcher: a run of a shorter period has at least LEAST_WORDS words
SLICE_CHARS = 1_000_000
LANES = 1 << 20

Run = tuple[int, int, int]  # start, length, period

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[*range(9, 14)]] = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(prints: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of twice the size."""
    return _mixed(prints[: len(prints) - size] * np.uint64(0x9E3779B97F4A7C15) + prints[size:])


class Catchers:
    """Repetitions in a buffer of word numbers; ``ends``: where the texts in it end, longest text first."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.words, self.starts, self.ends = words, starts, ends
        self.known: list[tuple[int, int, int]] = []  # start, end, period of repetitions of two periods or more
        self.runs: list[tuple[int, int, int]] = []

    def run_all(self) -> list[tuple[int, int, int]]:
        lengths = self.ends - self.starts
        prints = _mixed(self.words.astype(np.uint64))
        size = 1
        while True:
            periods = LEAST_PERIODS * size if size >= FIRST_SIZE else 0
            long_enough = int(np.searchsorted(-lengths, -max(LEAST_WORDS, periods), side="right"))
            if not long_enough:
                return self.runs
            until = int(self.ends[long_enough - 1]) + 1  # the last text's separator included
            prints = prints[: max(0, until - size + 1)]
            if size == FIRST_SIZE:
                for low in (1, 2, 4):
                    self.catch(prints, until, size, low, 2 * low)
            if size >= FIRST_SIZE:
                self.catch(prints, until, size, size, 2 * size)
            prints = _joined(prints, size)
            size *= 2

    def catch(self, prints: np.ndarray, until: int, size: int, low: int, high: int) -> None:
        """All repetitions of periods from ``low`` to below ``high`` that copy a whole block of ``size`` words."""
        blocks = len(prints) // size + 1
        known = sorted(k for k in self.known if k[1] - k[0] >= size + 2 * k[2] and 2 * k[2] < high)
        found_at, found_q = [], []
        step = max(1, LANES // (high - low))
        for first in range(0, blocks, step):
            at = np.arange(first, min(blocks, first + step)) * size
            at = at[at + low < len(prints)]
            if not len(at):
                break
            lanes = at[:, None] + np.arange(low, high)
            same = prints[np.minimum(lanes, len(prints) - 1)] == prints[at][:, None]
            rows, cols = np.nonzero(same & (lanes < len(prints)))
            p, q = at[rows], cols + low
            for start, end, period in known:
                a, b = np.searchsorted(p, (start, end))
                if a < b:
                    inside = (p[a:b] + q[a:b] + size <= end) & (q[a:b] % period == 0)
                    if inside.any():
                        keep = np.ones(len(p), bool)
                        keep[a:b] = ~inside
                        p, q = p[keep], q[keep]
            found_at.append(p)
            found_q.append(q)
        p, q = np.concatenate(found_at or [np.empty(0, np.int64)]), np.concatenate(found_q or [np.empty(0, np.int64)])
        if not len(p):
            return
        order = np.lexsort((p, q))
        p, q = p[order], q[order]
        new = np.flatnonzero(np.r_[True, (np.diff(q) != 0) | (np.diff(p) != size)])
        last = np.r_[new[1:], len(p)] - 1
        seen = set()
        for a, b, period in zip(p[new].tolist(), p[last].tolist(), q[new].tolist(), strict=True):
            for start, end in self.stretches(a, b, period, size, until):
                if (start, period) not in seen:
                    seen.add((start, period))
                    if end - start >= 2 * period:
                        self.known.append((start, end, period))
                    if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                        self.runs.append((start, end, period))

    def stretches(self, first: int, last: int, period: int, size: int, until: int) -> list[tuple[int, int]]:
        """Maximal stretches of this period around the blocks from ``first`` to ``last``, by comparing words."""
        lo, hi = max(0, first - size), min(until - period, last + 2 * size)
        differ = np.flatnonzero(self.words[lo:hi] != self.words[lo + period : hi + period])
        edges = np.r_[-1, differ, hi - lo]
        gaps = np.flatnonzero(np.diff(edges) > size)
        return [(lo + int(edges[g]) + 1, lo + int(edges[g + 1]) + period) for g in gaps]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word numbers of all texts in a row, and the offsets of the texts in these."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    blank = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_BLANK[raw])])
    split = pc.split_pattern(blank, b" ")
    flat = split.flatten()
    is_word = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    coded = flat.filter(pa.array(is_word)).dictionary_encode()
    before = np.r_[0, np.cumsum(is_word)]
    bounds = split.offsets.to_numpy().astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), before[bounds - bounds[0]]


def repeated(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place, where the contract repeats a part of this document; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def find_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """Runs of each text (word numbers of one numbering, not negative), by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= LEAST_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return out
    lengths = np.array([len(texts[i]) for i in order])
    starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    parts = [x for k, i in enumerate(order) for x in (texts[i], [-1 - k])]
    for start, end, period in Catchers(np.concatenate(parts), starts, starts + lengths).run_all():
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[order[k]].append((start - int(starts[k]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Places that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("n_words", pa.int64()), ("n_kept", pa.int64()),
])


def _report(ids: list[int | None], texts: pa.Array, repeat: bool) -> pa.RecordBatch:
    distinct, numbers, bounds = words_of(texts)
    words = [numbers[a:b] for a, b in zip(bounds, bounds[1:])]
    if repeat:
        places = [repeated(d, len(w)) for d, w in zip(ids, words, strict=True)]
        words = [w if p is None else w[p] for p, w in zip(places, words, strict=True)]
    found = find_runs(words)
    kept = [w[kept_words(len(w), r)] if r else w for w, r in zip(words, found, strict=True)]
    sizes = np.array([len(k) for k in kept], np.int64)
    whole = distinct.take(pa.array(np.concatenate([*kept, np.empty(0, np.int64)]).astype(np.int64)))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)]), whole), pa.scalar(b" ", whole.type))
    best = [min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None) for r in found]
    lists = ["".join(f"{s},{n},{q}\n" for s, n, q in r) for r in found]
    columns = [
        ids, [len(r) for r in found], *[[None if b is None else b[k] for b in best] for k in range(3)],
        [None if b is None else 1000 * b[1] // b[2] for b in best], [hashlib.sha256(x.encode()).hexdigest() for x in lists],
        [hashlib.sha256(x.as_buffer()).hexdigest() for x in joined], [len(w) for w in words], sizes.tolist(),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def _map(repeat: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // SLICE_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield _report(ids[a:b].to_pylist(), texts[a:b], repeat)

    return run


def report_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat: bool = False) -> DataFrame:
    """One row per document: its runs, the one of the greatest exponent, and digests of all runs and of the collapsed text.

    ``repeat``: first repeat parts of a tenth of the documents, as the query's contract says (:func:`repeated`).
    """
    types = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_map(repeat), types)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0)
        out = []
        for k in range(len(texts)):
            distinct, numbers, _ = words_of(texts[k : k + 1])
            kept = numbers[kept_words(len(numbers), find_runs([numbers])[0])]
            words = distinct.take(pa.array(kept))
            out.append(None if not texts[k].is_valid else b" ".join(w.as_buffer().to_pybytes() for w in words).decode())
        rest = [batch.column(i) for i in range(1, batch.num_columns)]
        yield pa.RecordBatch.from_arrays([pa.array(out, texts.type), *rest], names=batch.schema.names)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every run cut to its first period; all columns stay, words are joined by one space."""
    schema = docs.schema
    others = [c for c in docs.columns if c != text_col]
    names = [text_col, *others]
    out = docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(_collapse, schema.__class__([schema[c] for c in names]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

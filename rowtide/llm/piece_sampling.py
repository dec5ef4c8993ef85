"""Sampled segmentations of texts into pieces: forward filtering, backward sampling over the piece lattice.

A text becomes ``▁`` + text with spaces as ``▁``. Pieces hold ``▁`` only in front, so the lattice falls apart at each run
of ``▁`` (and at newlines) into words that are independent given the weights; filtering word by word is the filtering of
the whole lattice. The forward pass gives, for each word and position, the distribution of the piece that ends there;
it is computed once per distinct word of a batch. The backward pass draws pieces from the end of each occurrence.

The n-th draw of the m-th word of a row depends on the row's key, m and n alone, so a row's segmentation is the same in
every run, batch and partition. The vocabulary's rank r gives a piece the weight (r + 10) ** -alpha; a character outside
of the vocabulary becomes its bytes. Decoding joins the pieces and gives back the exact text.

Edge cases: null and empty texts have no pieces and decode to the empty text; words of any length are handled (long ones
one by one); a literal ``▁`` is written as its bytes; a null key is a key of its own; rows with equal keys and texts get
equal pieces; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LITERAL = "\n\n"  # stands for a literal SPACE; no word looks like this
ALPHA = 1.0
FALLBACK = 1e-9
CLASSES = (4, 6, 8, 10, 12, 16, 24, 48)
BASE = 0x9E3779B97F4A7C15
CELLS = 600_000
BATCH_CHARS = 2_000_000

_word = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
_lattices: dict[tuple, "Lattice"] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(key: np.ndarray, word: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit row keys, word numbers and the number of the draw in the word."""
    state = _mix(key + np.uint64(BASE) * (word.astype(np.uint64) + np.uint64(1)))
    return (_mix(state ^ np.uint64((BASE * (2 * step + 1)) & ((1 << 64) - 1))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Lattice:
    """Weights of a vocabulary's pieces, and the sampler."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte = np.zeros(256, np.int64)
        self.text: list[bytes] = []
        self.pieces: dict[str, tuple[int, float]] = {}
        rank = 0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or SPACE in piece.lstrip(SPACE) or "\n" in piece:
                self.text.append(b"")
            else:
                self.pieces[piece] = (i, float((rank + 10) ** -alpha))
                self.text.append(piece.replace(SPACE, " ").encode())
                rank += 1
        self.longest = max(map(len, self.pieces))
        self.tables: list[tuple] = [()]
        for n in range(1, self.longest + 1):
            own = [p for p in self.pieces if len(p) == n]
            h = self._hash(np.array(own, f"U{n}").view(np.uint32).reshape(-1, n)) if own else np.empty(0, np.uint64)
            order = np.argsort(h)
            ids = np.array([self.pieces[p][0] for p in own], np.int64)[order] if own else np.empty(0, np.int64)
            weights = np.array([self.pieces[p][1] for p in own])[order] if own else np.empty(0)
            maybe = np.zeros(1 << 18, bool)
            maybe[h & np.uint64((1 << 18) - 1)] = True
            self.tables.append((h[order], ids, weights, maybe))

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for j in range(codes.shape[1]):
            h = _mix(h + codes[:, j].astype(np.uint64) + np.uint64(1))
        return h

    def bytes_of(self, char: str) -> list[int]:
        return self.byte[list(char.encode("utf-8", "surrogatepass"))].tolist()

    def filtered(self, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Forward pass of words of up to ``width`` characters.

        ``share[w, e, n - 1]``: chance that the piece ending at e has at most n characters; ``ids[w, e, n - 1]``: that
        piece, or -1 - code point for a character outside of the vocabulary.
        """
        codes = np.array(words, f"U{width}").view(np.uint32).reshape(-1, width)
        longest = min(self.longest, width)
        ids = np.zeros((len(words), width + 1, longest), np.int64)
        weight = np.zeros((len(words), width + 1, longest))
        h = np.zeros((len(words), width + 1), np.uint64)
        for n in range(1, longest + 1):
            starts = width - n + 1
            h = _mix(h[:, :starts] + codes[:, n - 1 : n - 1 + starts].astype(np.uint64) + np.uint64(1))
            keys, piece_ids, weights, maybe = self.tables[n]
            w, s = np.nonzero(maybe[h & np.uint64((1 << 18) - 1)])
            if len(keys) and len(w):
                own = h[w, s]
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                ids[w[hit], s[hit] + n, n - 1] = piece_ids[at[hit]]
                weight[w[hit], s[hit] + n, n - 1] = weights[at[hit]]
        w, s = np.nonzero(weight[:, 1:, 0] == 0)
        ids[w, s + 1, 0] = -1 - codes[w, s].astype(np.int64)
        weight[w, s + 1, 0] = FALLBACK
        ahead = np.zeros((len(words), width + 1))
        ahead[:, 0] = 1
        share = weight
        for e in range(1, width + 1):
            reach = min(longest, e)
            parts = ahead[:, e - reach : e][:, ::-1] * weight[:, e, :reach]
            total = parts.sum(1)
            share[:, e, :reach] = np.cumsum(parts, 1) / np.maximum(total, 1e-300)[:, None]
            share[:, e, reach - 1 :] = 2.0  # the last piece takes what rounding leaves
            ahead[:, e] = total
            small = total < 1e-120
            if small.any():  # only the columns that later steps read
                ahead[small, max(0, e - longest) : e + 1] *= 1e120
        return share, ids

    def sample_long(self, word: str, key: int, number: int) -> list[int]:
        """One long word, by the same rule and the same draws."""
        size, width = len(word), self.longest
        ahead = np.zeros(size + 1)
        ahead[0] = 1
        edges: list[tuple] = [()]
        for e in range(1, size + 1):
            found = [(n, *self.pieces[p]) for n in range(1, min(width, e) + 1) if (p := word[e - n : e]) in self.pieces]
            if not found or found[0][0] != 1:
                found.insert(0, (1, -1 - ord(word[e - 1]), FALLBACK))
            cum = np.cumsum([ahead[e - n] * w for n, _, w in found])
            edges.append(([(n, i) for n, i, _ in found], cum / cum[-1]))  # now: later steps rescale
            ahead[e] = cum[-1]
            if ahead[e] < 1e-120:
                ahead[max(0, e - width) : e + 1] *= 1e120
        out, e, step = [], size, 0
        keys, numbers = np.array([key], np.uint64), np.array([number])
        while e:
            found, cum = edges[e]
            n, i = found[min(int((draws(keys, numbers, step)[0] >= cum).sum()), len(found) - 1)]
            out.append(i)
            e, step = e - n, step + 1
        return out[::-1]

    def sample(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text."""
        split = [[] if not t else self._with_literal(t) if SPACE in t else _word.findall(SPACE + t.replace(" ", SPACE)) for t in texts]
        count = np.fromiter(map(len, split), np.int64, len(split))
        if not count.sum():
            return [np.empty(0, np.int64) for _ in texts]
        coded = pa.array(chain.from_iterable(split), pa.large_string()).dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(texts)), count)
        place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        size = np.array([0 if w == LITERAL else len(w) for w in words])
        steps = np.zeros(len(at), np.int64)
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for width in CLASSES:
            own = np.flatnonzero((size > low) & (size <= width))
            low = width
            span = max(1, CELLS // ((width + 1) * min(width, self.longest)))
            where = np.full(len(words), -1)
            where[own] = np.arange(len(own))
            rank = where[at]
            order = np.argsort(rank, kind="stable")
            ranked = rank[order]
            for lo in range(0, len(own), span):
                group = own[lo : lo + span]
                share, ids = self.filtered([words[i] for i in group], width)
                occ = order[np.searchsorted(ranked, lo) : np.searchsorted(ranked, lo + len(group))]
                w, e, step = rank[occ] - lo, size[at[occ]], 0
                while len(occ):
                    u = draws(keys[row[occ]], place[occ], step)
                    n = (u[:, None] >= share[w, e]).sum(1)
                    made.append((occ, np.full(len(occ), step), ids[w, e, n]))
                    steps[occ] += 1
                    e = e - n - 1
                    left = e > 0
                    occ, w, e, step = occ[left], w[left], e[left], step + 1
        for o in np.flatnonzero((size[at] > CLASSES[-1]) | (size[at] == 0)):
            word = words[at[o]]
            drawn = [-1 - ord(SPACE)] if word == LITERAL else self.sample_long(word, int(keys[row[o]]), int(place[o]))
            steps[o] = len(drawn)
            made.append((np.full(len(drawn), o), np.arange(len(drawn))[::-1], np.array(drawn, np.int64)))
        first = np.cumsum(steps) - steps
        out = np.zeros(steps.sum(), np.int64)
        for occ, step, ids in made:
            out[first[occ] + steps[occ] - 1 - step] = ids
        bounds = np.searchsorted(row, np.arange(len(texts) + 1))
        ends = np.r_[first, len(out)][bounds]
        return [self._with_bytes(out[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    @staticmethod
    def _with_literal(text: str) -> list[str]:
        """Words of a text that holds ``▁`` itself, which becomes the word LITERAL."""
        found: list[str] = []
        for k, part in enumerate(f" {text}".split(SPACE)):
            found += [LITERAL] * (k > 0) + _word.findall(part.replace(" ", SPACE))
        return found

    def _with_bytes(self, ids: np.ndarray) -> np.ndarray:
        """Negative ids (characters outside of the vocabulary) become the pieces of their bytes."""
        single = (ids < 0) & (ids >= -128)
        ids[single] = self.byte[-1 - ids[single]]
        if not (ids < 0).any():
            return ids
        return np.concatenate([np.array(self.bytes_of(chr(-1 - i)) if i < 0 else [i], np.int64) for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.text.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


def lattice(path: str, alpha: float = ALPHA) -> Lattice:
    if (path, alpha) not in _lattices:
        _lattices[path, alpha] = Lattice(path, alpha)
    return _lattices[path, alpha]


def _slices(texts: list[str | None]) -> Iterator[slice]:
    lo, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= BATCH_CHARS:
            yield slice(lo, i + 1)
            lo, chars = i + 1, 0
    yield slice(lo, len(texts))


def sample_pieces(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", seed: int = 0, alpha: float = ALPHA, with_ids: bool = True) -> DataFrame:
    """``docs`` with ``pieces``: ids (if ``with_ids``), their number and CRC-32, and whether they decode to the text."""
    kind = ("ids array<int>, " if with_ids else "") + "n_pieces long, ids_crc32 long, lossless boolean"

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = lattice(path, alpha)
        for key, text in batches:
            keys, texts, rows = key.to_numpy(np.int64).view(np.uint64), list(text), []
            for part in _slices(texts):
                for t, ids in zip(texts[part], own.sample(texts[part], keys[part]), strict=True):
                    rows.append((*([ids.astype(np.int32)] if with_ids else []), len(ids), zlib.crc32(ids.astype("<u4").tobytes()), own.decode(ids) == (t or "")))
            yield pd.DataFrame(rows, columns=[*(["ids"] if with_ids else []), "n_pieces", "ids_crc32", "lossless"])

    return docs.withColumn("pieces", run(F.xxhash64(F.lit(seed), F.col(key_col)), F.col(text_col)))


def decode_pieces(frame: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``frame`` with ``decoded``: the text of its piece ids."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = lattice(path)
        for ids in batches:
            yield pd.Series([own.decode(np.array(i if i is not None else [], np.int64)) for i in ids])

    return frame.withColumn("decoded", run(F.col(ids_col)))

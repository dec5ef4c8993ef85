"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

1. Documents are tokenised in Arrow batches; each distinct word is tokenised once per worker (the tokenizer splits at
   white space before it merges, so words are independent). Longer documents are cut into full pieces and a rest.
   Slim piece rows (no texts, no ids) are written once.
2. Bulk-synchronous best fit. A round takes all pieces of one length, from the longest to the shortest. A sweep over
   the gaps, sorted by size, finds the successor gap (the smallest that holds the length); pieces are matched to these
   gaps by rank, gaps are updated, and the round repeats on the next successor until its pieces are placed. Where no
   gap is left, new sequences open. As pieces of one length and gaps of one size are alike, a round works on
   (length, count) and (gap, runs of sequences): tables bounded by the capacity, whatever the corpus. This is the
   result of sequential best-fit-decreasing.
3. Conflicts are resolved by rank: each piece's rank within its length comes from a distributed sort (hashed buckets,
   counts, running offsets), and a join with the plan's rank runs gives sequence and offset.

Edge cases: null text is empty and gives the single end id; equal rows are packed once each; ranks break ties by id,
piece and digest; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import releasing
from rowtide.session import materialize

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 120_000
RANK_ROWS = 50_000
BATCH_BYTES = 2_000_000
GATHER_WORDS = 1 << 18

# Fixed values of the tokenizer's vocabulary file: its pre-tokens (for words of the plain letters), and the letters of bytes.
_plain = re.compile("[!-@\\[-~ß-öø-ÿ]*")
_parts = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")
_visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
_byte_letter = {b: chr(b) for b in _visible} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _visible)}


# The rules that word-wise coding relies on; a file with others is coded by its whole tokenizer.
_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_lower[[9, 10]] = 32
_ids = [struct.Struct(f"<{n}I").pack for n in range(64)]


def pack_ids(ids: list[int]) -> bytes:
    return _ids[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)


def plain_bytes(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, tabs and line ends as spaces: one look at every byte."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_lower[raw]))


_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of texts, by a bounded word cache in front of a tokenizer that splits at white space.

    A-Z is lowered first, which the tokenizer does too. Words of ASCII and small Latin-1 letters are cut into the
    tokenizer's pre-tokens here, and only new pre-tokens go to its merges; all other words go through the whole
    tokenizer. The cache has two generations of ``CACHE_WORDS`` words: words that stay in use stay known. The ids of a
    slice of texts are gathered from those of its distinct words. A tokenizer file with other rules than these is used whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.by_word = all(rules.get(k) == v for k, v in _RULES.items()) and rules["model"].get("type") == "BPE"
        self.special = tuple(t["content"] for t in rules.get("added_tokens", []))
        self.tokenize = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        found = self.known.get(part) or self.older.get(part)
        if found is None:
            letters = part if part.isascii() else "".join(map(_byte_letter.__getitem__, part.encode()))
            found = pack_ids([t.id for t in self.tokenize(letters)])
        self.known[part] = found
        return found

    def _word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            found = pack_ids([t.id for t in self.tokenize(word)])
        elif not _plain.fullmatch(word):
            found = self._whole(word)
        else:
            found = b"".join(map(self._part, _parts.findall(word)))
        return found

    def _lookup(self, words: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {"": b""}
        known, older = self.known, self.older
        ids = list(map(known.get, words))
        for i, found in enumerate(ids):
            if found is None:
                word = words[i]
                found = older.get(word)
                if found is None:
                    found = self._word(word)
                ids[i] = known[word] = found
        return ids

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text (null: none). Texts that may hold special tokens go through the tokenizer."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            return [self._whole(t) for t in texts.to_pylist()]
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        spaced = plain_bytes(plain)
        apart = pc.replace_substring_regex(spaced, "([a-zß-öø-ÿ])([.,])( |$)", r"\1 \2\3")  # a pre-token ends there anyway
        split = pc.split_pattern(apart, " ")
        coded = split.flatten().dictionary_encode()
        ids = self._lookup(coded.dictionary.to_pylist())
        flat, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        at, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
        before = np.r_[0, np.cumsum(sizes[at])][ends]  # ids before each text
        out = np.empty(before[-1], "<u4")
        done = 0
        for k in range(0, len(at), GATHER_WORDS):
            words = at[k : k + GATHER_WORDS]
            n = sizes[words]
            total = int(n.sum())
            out[done : done + total] = flat[np.arange(total) + np.repeat(starts[words] - (np.cumsum(n) - n), n)]
            done += total
        raw = out.tobytes()
        cut = (4 * before).tolist()
        return [self._whole(texts[i].as_py()) if special[i] else raw[a:b] for i, (a, b) in enumerate(zip(cut, cut[1:]))]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``BATCH_BYTES`` bytes."""
    part = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(path: str, capacity: int, end_id: int) -> Callable:
    end = pack_ids([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            for a, b in slices(texts):
                rows = []
                for doc_id, ids in zip(batch.column(0)[a:b].to_pylist(), own.encode(texts[a:b]), strict=True):
                    ids += end
                    for k, s in enumerate(range(0, len(ids) // 4, capacity)):
                        cut = ids[4 * s : 4 * (s + capacity)]
                        rows.append((doc_id, k, s, len(cut) // 4, zlib.crc32(cut)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return run


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the tokens of every document and the end id, cut at the capacity."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(releasing(_pieces(path, capacity, end_id)), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces, first sequence, offset)``: one run puts one piece in each of its sequences."""
    gaps: dict[int, deque] = {}
    sizes: list[int] = []
    plan, sequences = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap not in gaps:
            gaps[gap] = deque()
            insort(sizes, gap)
        gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                n = -(-left // (capacity // length))
                put(capacity, sequences, n)
                sequences += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].popleft()
            take = min(n, left)
            if take < n:
                gaps[gap].appendleft((first + take, n - take))
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            plan.append((length, rank, take, first, capacity - gap))
            rank, left = rank + take, left - take
            if gap > length:
                put(gap - length, first, take)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length, ids_crc32) of 1 to ``capacity`` tokens."""
    spark = pieces.sparkSession
    pieces = materialize(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    buckets = -(-max(counts.values(), default=1) // RANK_ROWS)
    hashed = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bases = hashed.groupBy("length", "_b").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = hashed.withColumn("_own", F.row_number().over(own) - 1).join(bases, ["length", "_b"]).withColumn("_rank", F.col("_own") + F.col("_base"))
    plan = spark.createDataFrame(best_fit_plan(counts, capacity) or [], "length long, lo long, n long, sequence long, offset long")
    placed = ranked.join(F.broadcast(plan.withColumnRenamed("length", "_l")), (F.col("length") == F.col("_l")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("lo") + F.col("n")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("_rank") - F.col("lo")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, path, id_col, text_col, capacity, end_id), capacity)

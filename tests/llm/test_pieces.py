from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rowtide.llm.piece_sampling import FALLBACK, Lattice, decode_pieces, sample_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " two  spaces\nand\tlines \n\n", "a ▁ literal ▁▁", "日本語 ü ß 😀 \x00 \U0010ffff", "x" * 300, "word " * 50, "é" * 70 + "q" * 60, "the thing"]


@pytest.fixture(scope="module")
def own():
    return Lattice(PATH)


def all_paths(own, word):
    """Every segmentation of a word with its weight."""
    out = []

    def walk(at, ids, weight):
        if at == len(word):
            out.append((tuple(ids), weight))
        for n in range(1, min(own.longest, len(word) - at) + 1):
            if (p := word[at : at + n]) in own.pieces:
                walk(at + n, [*ids, own.pieces[p][0]], weight * own.pieces[p][1])
            elif n == 1:
                walk(at + 1, [*ids, *own.bytes_of(p)], weight * FALLBACK)

    walk(0, [], 1.0)
    return out


def test_lossless(own):
    keys = np.arange(len(TEXTS), dtype=np.uint64)
    for text, ids in zip(TEXTS, own.sample(TEXTS, keys), strict=True):
        assert own.decode(ids) == text


def test_samples_follow_the_lattice(own):
    paths = all_paths(own, "▁thing")
    total = sum(w for _, w in paths)
    n = 20000
    seen = Counter(tuple(ids.tolist()) for ids in own.sample(["thing"] * n, np.arange(n, dtype=np.uint64)))
    for ids, w in paths:
        p = w / total
        assert abs(seen[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4
    long = Counter(tuple(own.sample_long("▁thing", k, 0)) for k in range(2000))
    best = max(paths, key=lambda x: x[1])
    assert abs(long[best[0]] / 2000 - best[1] / total) < 0.06


def test_long_words_draw_as_short_ones(own):
    for k in range(50):
        assert own.sample_long("▁thing", k, 0) == own.sample(["thing"], np.array([k], np.uint64))[0].tolist()


def test_independent_of_the_batch(own):
    keys = np.arange(len(TEXTS), dtype=np.uint64)
    whole = own.sample(TEXTS, keys)
    for i, text in enumerate(TEXTS):
        assert own.sample([text], keys[i : i + 1])[0].tolist() == whole[i].tolist()


def test_frame(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, None, 2), (None, "ab", 3), (8, "the thing", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = decode_pieces(sample_pieces(docs, PATH).select("doc_id", "text", "pieces.*"), PATH).collect()
    assert all(r.lossless and r.decoded == (r.text or "") and r.n_pieces == len(r.ids) for r in out)
    assert len({tuple(r.ids) for r in out if r.doc_id == 8}) == 1
    assert sample_pieces(docs.limit(0), PATH).count() == 0

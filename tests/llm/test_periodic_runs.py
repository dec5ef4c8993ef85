"""Periodic runs against a plain search, on random texts, hard words and odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from rowtide.llm import periodic_runs
from tests.llm import brute


def check(texts):
    for t, got in zip(texts, periodic_runs.find_runs([np.array(t, np.int64) for t in texts]), strict=True):
        assert got == brute.word_runs(t)


@pytest.mark.parametrize("seed", range(40))
def test_random_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randint(1, 6)):
        k = rng.choice([1, 2, 2, 3, 5, 50])
        w = [rng.randrange(k) for _ in range(rng.randint(0, 140))]
        for _ in range(rng.randint(0, 3)):
            p = [rng.randrange(k) for _ in range(rng.randint(1, 40))]
            at = rng.randint(0, len(w))
            w[at:at] = (p * rng.randint(1, 10))[: rng.randint(1, 160)]
        texts.append(w)
    check(texts)


def test_hard_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    check([[ord(c) for c in fib[-1][:400]], [bin(i).count("1") & 1 for i in range(300)], [0] * 200, [i % 7 for i in range(23)], [i % 8 for i in range(24)], [i % 9 for i in range(27)], [i % 9 for i in range(26)]])


def test_level_bounds():
    for q in (7, 8, 9, 15, 16, 17, 31, 32, 33):
        for shift in range(0, 34, 3):
            check([[100 + i for i in range(shift)] + [i % q for i in range(max(24, 3 * q))] + [90, 91], [100 + i for i in range(shift)] + [i % q for i in range(max(24, 3 * q) - 1)] + [90]])


def expected(doc_id, text):
    w = brute.words(text)
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute.word_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_odd_rows(spark):
    rng = random.Random(3)
    prose = " ".join(rng.choice(["ab", "cde", "f", "ghi", "j\u00e9", "\u3000k"]) for _ in range(300))
    loop = " \t".join(["x", "y", "z", "\u0436"] * 12)
    rows = [(i, t, "n", 0) for i, t in enumerate([None, "", " \n\t\x0b", "one", loop, loop, f"a {loop} b", prose, "x " * 500, "\x1c".join("ab" * 30)] + [f"{prose} {i}" for i in range(40)])]
    rows += [rows[4], (None, loop, None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, start int")
    got = sorted((tuple(r)[:8] for r in periodic_runs.report_runs(docs, repeat=True).collect()), key=str)
    assert got == sorted((expected(d, t) for d, t, *_ in rows), key=str)
    assert periodic_runs.report_runs(docs.limit(0)).count() == 0
    short = {r.doc_id: r for r in periodic_runs.collapse(docs.where("doc_id in (0, 4, 6)")).collect()}
    assert short[0].text is None and short[4].text == "x y z \u0436" and short[6].text == "a x y z \u0436 b" and short[6].asDict().keys() == set(docs.columns)


def test_long_text(spark):
    w = [str(i % 4001) for i in range(60_000)] + [f"u{i}" for i in range(500)] + ["z"] * 60_000
    docs = spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")
    row = periodic_runs.report_runs(docs).first()
    assert (row.n_runs, row.start, row.length, row.period) == (2, 60_500, 60_000, 1)
    assert row.collapsed_sha256 == hashlib.sha256(" ".join([*w[:4001], *w[60_000:60_501]]).encode()).hexdigest()
    assert row.runs_sha256 == hashlib.sha256(b"0,60000,4001\n60500,60000,1\n").hexdigest()


def test_sf_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 6000")
    got = sorted((tuple(r)[:8] for r in periodic_runs.report_runs(docs, repeat=True).collect()), key=str)
    assert got == sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=str)

"""Vector codes against a plain version; odd rows."""

import math
import random

import pytest

from rowtide.llm import vector_codes
from tests.llm import brute

DDL = "vec_id long, embedding array<float>, label int, code string, error int"


def plain(rows, parts=16, entries=64):
    kept = [(i, v, y) for i, v, y, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = sorted(((i, [math.floor(256 * x) for x in v], y) for i, v, y in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    found, books = brute.vector_codes([v for _, v, _ in whole], parts, entries)
    total = {}
    for (_, _, y), (_, e) in zip(whole, found, strict=True):
        total[y] = total.get(y, 0) + e
    return sorted(((i, c, e, total[y]) for (i, _, y), (c, e) in zip(whole, found, strict=True)), key=str), books


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    grid = [k / 128 for k in range(-128, 129)]
    out = [(i, [rng.choice(grid) for _ in range(64)], rng.choice([None, 1, 2]), "x", 1) for i in range(200)]
    out += [out[5], out[5], (7, out[9][1], None, "x", 1), (None, out[3][1], 2, None, None), (300, None, 1, None, None), (301, [math.nan] * 64, 1, None, None), (302, [math.inf, *[0.0] * 63], 1, None, None), (303, [None, *[0.0] * 63], 1, None, None)]
    return out


def test_against_plain(spark, rows):
    got = vector_codes.report(spark.createDataFrame(rows, DDL)).collect()
    want, books = plain(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    flat = ",".join(str(x) for book in books for e in book for x in e)
    import hashlib

    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(flat.encode()).hexdigest()}


def test_few_vectors_and_wide_values(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1000, 1000) for _ in range(32)], i % 2, None, None) for i in range(20)]
    rows = [(i, [float(int(x * 64)) / 64 for x in v], *r) for i, v, *r in rows]
    got = vector_codes.report(spark.createDataFrame(rows, DDL)).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == plain(rows)[0]


def test_odd_tables(spark, rows):
    frame = spark.createDataFrame(rows, DDL)
    assert vector_codes.report(frame.limit(0)).count() == 0
    assert vector_codes.report(frame.where("vec_id >= 300")).count() == 0
    odd = spark.createDataFrame([(1, [], 1, None, None), (2, [1.0], 1, None, None), (3, [3e38] * 20, 1, None, None)], DDL)
    got = {r.vec_id: r for r in vector_codes.report(odd).collect()}
    assert got.keys() == {1, 2, 3} and got[3].error == 0


def test_round_trip_of_codes(spark, rows):
    coded, books = vector_codes.compress(spark.createDataFrame(rows[:60], DDL))
    # fewer vectors than entries: every vector is an entry of its own, so codes name the floored means exactly
    back = {r.vec_id: r.v for r in vector_codes.decompress(coded, books).collect()}
    for i, v, *_ in rows[:60]:
        assert back[i] == [math.floor(256 * x) for x in v]

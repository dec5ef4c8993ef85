"""Restrictions on any columns, key moves with partial images and unique keys in one log, against a sequential engine."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.distribute import ROUTES_DDL
from rowtide.operators.segmented import apply_log
from rowtide.plans.pipeline import run_destination
from tests.sequential import run as sequential

DDL = "seq long, action string, data map<string,string>, restriction map<string,string>"
PLAIN = TableContract(name="t", columns=(("k", "bigint"), ("g", "string"), ("h", "bigint"), ("v", "string")), primary_key=("k",), required=frozenset({"g"}), defaults={"h": 7})
PAIRS = TableContract(name="p", columns=(("o", "bigint"), ("n", "bigint"), ("u", "string"), ("g", "string")), primary_key=("o", "n"), unique_keys=(("u",),))
TWO = TableContract(name="w", columns=(("k", "bigint"), ("a", "string"), ("b", "string"), ("g", "string")), primary_key=("k",), unique_keys=(("a", "b"),))


def applied(spark, contract, base, log, **kw):
    res = apply_log(spark.createDataFrame(base, contract.schema), spark.createDataFrame(log, DDL), contract, **kw)
    out = {r.seq: (r.outcome, r["rows"]) for r in res.outcomes.collect()}
    assert res.outcomes.count() == len(log)
    return sorted((tuple(r) for r in res.table.collect()), key=str), out


def same(spark, contract, base, log, **kw):
    got, want = applied(spark, contract, base, log, **kw), sequential(base, log, contract)
    assert got[1] == want[1]
    assert got[0] == want[0]


def plain_log(rng, n, moves):
    g, k = (lambda: f"g{rng.randint(1, 4)}"), (lambda: str(rng.randint(1, 12)))
    log = []
    for seq in range(1, n + 1):
        kind = rng.choice(["add", "set", "update", "delete", "by_g", "by_gh", "del_g", "chain", *(["move", "move_g"] if moves else [])])
        log.append({
            "add": (seq, "add", {"k": k(), "g": g(), "v": f"a{seq}"}, None),
            "set": (seq, "set", {"k": k(), "g": g()} | ({"h": str(rng.randint(6, 8))} if rng.random() < 0.5 else {}), None),
            "update": (seq, "update", rng.choice([{"v": f"u{seq}"}, {"g": g()}, {"g": None}]), {"k": k()}),
            "delete": (seq, "delete", None, {"k": k()}),
            "by_g": (seq, "update", rng.choice([{"v": f"b{seq}"}, {"g": g()}, {"h": "8"}, {"g": None}]), {"g": g()}),
            "by_gh": (seq, "update", {"h": str(rng.randint(6, 8)), "v": f"c{seq}"}, {"g": g(), "h": str(rng.randint(6, 8))}),
            "del_g": (seq, "delete", None, {"g": g(), "k": k()}),
            "chain": (seq, "update", {"h": str(rng.randint(6, 9))}, {"h": str(rng.randint(6, 9))}),
            "move": (seq, "update", {"k": k()} | ({"v": f"m{seq}"} if rng.random() < 0.5 else {}), {"k": k()}),
            "move_g": (seq, "update", {"k": k()}, {"v": f"a{rng.randint(1, n)}"}),
        }[kind])
    return [p for p in log if not (p[1] == "update" and p[3].keys() == {"k"} and p[2].get("k") == p[3]["k"])]


@pytest.mark.parametrize("seed, moves, span, broadcast", [(1, False, 4, 0), (3, True, 8, 1 << 20)])
def test_plain_rows(spark, seed, moves, span, broadcast):
    rng = random.Random(seed)
    base = [(i, f"g{i % 4 + 1}", 7, "b") for i in range(1, 8)]
    same(spark, PLAIN, base, plain_log(rng, 28, moves), span=span, broadcast_bytes=broadcast)


def test_composite_keys_with_a_unique_column(spark):
    rng = random.Random(1)
    o, n, u, g = (lambda: str(rng.randint(1, 3))), (lambda: str(rng.randint(1, 4))), (lambda: f"u{rng.randint(1, 14)}"), (lambda: f"g{rng.randint(1, 3)}")
    log = []
    for seq in range(1, 31):
        kind = rng.choice(["add", "set", "update", "part", "part_set", "del_part", "by_g", "del_g", "by_u", "move", "move_part"])
        log.append({
            "add": (seq, "add", {"o": o(), "n": n(), "u": u(), "g": g()}, None),
            "set": (seq, "set", {"o": o(), "n": n(), "u": u()}, None),
            "update": (seq, "update", {"u": u()}, {"o": o(), "n": n()}),
            "part": (seq, "update", rng.choice([{"u": u()}, {"g": g()}]), {"o": o()}),
            "part_set": (seq, "set", {"n": n(), "g": g()}, None),
            "del_part": (seq, "delete", None, {"n": n()}),
            "by_g": (seq, "update", {"u": u()}, {"g": g()}),
            "del_g": (seq, "delete", None, {"g": g()}),
            "by_u": (seq, "update", {"g": g()}, {"u": u()}),
            "move": (seq, "update", {"n": n()}, {"o": o(), "n": n()}),
            "move_part": (seq, "update", {"n": n()}, {"o": o()}),
        }[kind])
    log = [p for p in log if not (p[1] == "update" and p[3].keys() == {"o", "n"} and "n" in p[2] and p[2]["n"] == p[3]["n"])]
    same(spark, PAIRS, [(i, j, f"u{4 * i + j}", f"g{j}") for i in (1, 2) for j in (1, 2, 3)], log, broadcast_bytes=0)


GRID = TableContract(name="g", columns=(("o", "bigint"), ("n", "bigint"), ("t", "string"), ("w", "string")), primary_key=("o", "n"), required=frozenset({"t"}), defaults={"w": "d"})


@pytest.mark.parametrize("seed, span, broadcast", [(1, 3, 0), (2, 1 << 20, 1 << 20)])
def test_parts_of_keys(spark, seed, span, broadcast):
    rng = random.Random(seed)
    o, n, log = (lambda: str(rng.randint(1, 4))), (lambda: str(rng.randint(1, 4))), []
    for seq in range(1, 121):
        kind = rng.choice(["add", "set", "update", "delete", "by_o", "by_n", "set_o", "set_n", "halt", *(["del_o", "del_n"] if rng.random() < 0.5 else [])])
        log.append({
            "add": (seq, "add", {"o": o(), "n": n(), "t": f"a{seq}"}, None),
            "set": (seq, "set", {"o": o(), "n": n()} | ({"t": f"s{seq}"} if rng.random() < 0.6 else {"w": f"s{seq}"}), None),
            "update": (seq, "update", {"t": f"u{seq}"}, {"o": o(), "n": n()}),
            "delete": (seq, "delete", None, {"o": o(), "n": n()}),
            "by_o": (seq, "update", {"t": f"p{seq}"}, {"o": o()}),
            "by_n": (seq, "update", {"w": rng.choice([None, f"q{seq}"])}, {"n": n()}),
            "set_o": (seq, "set", {"o": o(), "w": f"r{seq}"}, None),
            "set_n": (seq, "set", {"n": n(), "t": rng.choice([None, f"x{seq}"])}, None),
            "halt": (seq, "update", {"t": None}, {"o": o()}),
            "del_o": (seq, "delete", None, {"o": o()}),
            "del_n": (seq, "delete", None, {"n": n()}),
        }[kind])
    base = [(i, j, "b", None) for i in (1, 2, 3) for j in (1, 2, 5)]
    same(spark, GRID, base, log, span=span, broadcast_bytes=broadcast)


def test_moves_of_a_part_of_the_key(spark):
    base = [(1, 1, "a", "x"), (1, 2, "b", "x"), (2, 1, "c", "y"), (5, 2, "d", "y")]
    log = [(1, "update", {"o": "5"}, {"o": "1"}), (2, "delete", None, {"n": "2", "g": "y"}), (3, "update", {"o": "5"}, {"o": "1"}), (4, "update", {"g": "z"}, {"o": "5"}), (5, "update", {"n": "3"}, {"g": "z"}), (6, "update", {"o": "7", "g": "w"}, {"u": "b"})]
    same(spark, PAIRS, base, log)


def test_unique_pairs_written_in_part(spark):
    base = [(1, "a", "x", "g"), (2, "b", "x", "g"), (3, "c", "y", "h")]
    log = [(1, "update", {"a": "b"}, {"k": "1"}), (2, "update", {"b": "y"}, {"k": "2"}), (3, "update", {"a": "b"}, {"k": "1"}), (4, "update", {"b": "y"}, {"g": "g"}), (5, "update", {"a": "c", "b": "y"}, {"k": "1"})]
    same(spark, TWO, base, log)


def test_reported_cases(spark):
    one = TableContract(name="q", columns=(("k", "bigint"), ("u", "string"), ("g", "string")), primary_key=("k",), unique_keys=(("u",),))
    same(spark, one, [(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], [(1, "update", {"u": "z"}, {"g": "x"}), (2, "update", {"u": "a"}, {"g": "y"}), (3, "delete", None, {"g": "x"}), (4, "update", {"u": "a"}, {"g": "y"})])
    same(spark, PAIRS, [(1, 1, "a", "x"), (1, 2, "b", "x")], [(1, "update", {"u": "z"}, {"o": "1"}), (2, "delete", None, {"o": "1"}), (3, "add", {"o": "2", "n": "1", "u": "a"}, None)])


def test_a_thousand_restrictions_take_few_rounds(spark, monkeypatch):
    from rowtide.operators import segmented

    rounds = []
    find = segmented.find_hits
    monkeypatch.setattr(segmented, "find_hits", lambda *a, **k: rounds.append(1) or find(*a, **k))
    base = [(i, f"g{i % 50}", i % 5, "b") for i in range(500)]
    log = [(i, *(("delete", None, {"g": f"g{i % 61}", "h": "4"}) if i % 7 == 0 else ("update", {"v": f"n{i}"}, {"g": f"g{i % 61}"}))) for i in range(1, 1001)]
    same(spark, PLAIN, base, log)
    assert len(rounds) <= 3


@pytest.mark.parametrize("contract", [PLAIN, PAIRS])
def test_replicas_equal_the_destination(spark, contract):
    if contract is PLAIN:
        base, log = [(i, f"g{i % 4 + 1}", 7, "b") for i in range(1, 8)], plain_log(random.Random(7), 12, True)
    else:
        base = [(1, 1, "a", "x"), (1, 2, "b", "x"), (2, 1, "c", "y")]
        log = [(1, "update", {"n": "5"}, {"o": "1", "n": "2"}), (2, "set", {"o": "1", "g": "w"}, None), (3, "update", {"u": "d"}, {"g": "y"}), (4, "update", {"u": "b"}, {"g": "y"}), (5, "delete", None, {"g": "w", "n": "1"}), (6, "add", {"o": "9", "n": "9", "u": "a"}, None)]
    routes = spark.createDataFrame([("d", t, "q", "t", t != "off") for t in ("one", "two", "off")], ROUTES_DDL)
    frame = spark.createDataFrame(base, contract.schema)
    bases = frame.withColumn("target", F.lit("one")).unionByName(frame.withColumn("target", F.lit("two")))
    res = run_destination(frame, spark.createDataFrame(log, DDL), routes, contract, "d", bases)
    want = sequential(base, log, contract)[0]
    assert sorted((tuple(r) for r in res.destination.table.collect()), key=str) == want
    got = [r for r in res.targets.table.select("target", *contract.names).collect()]
    for t in ("one", "two"):
        assert sorted((tuple(r)[1:] for r in got if r.target == t), key=str) == want
    assert {r.target for r in got} <= {"one", "two"}


def test_replicas_with_other_bases_are_hit_otherwise(spark):
    routes = spark.createDataFrame([("d", "r", "q", "t", True)], ROUTES_DDL)
    log = [(1, "update", {"v": "x"}, {"g": "g1"}), (2, "delete", None, {"g": "g2"})]
    base, other = [(1, "g1", 7, "a"), (2, "g2", 7, "b")], [(1, "g2", 7, "a"), (3, "g1", 7, "c")]
    frame = spark.createDataFrame(base, PLAIN.schema)
    bases = spark.createDataFrame(other, PLAIN.schema).withColumn("target", F.lit("r"))
    res = run_destination(frame, spark.createDataFrame(log, DDL), routes, PLAIN, "d", bases)
    assert sorted(tuple(r) for r in res.destination.table.collect()) == [(1, "g1", 7, "x")]
    assert sorted(tuple(r) for r in res.targets.table.select(*PLAIN.names).collect()) == [(3, "g1", 7, "x")]

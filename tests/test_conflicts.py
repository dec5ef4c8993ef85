"""Unique keys, key moves, shared seqs and barriers against a plain sequential replay."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.contract import ForeignKey, TableContract
from rowtide.operators.distribute import apply_targets
from rowtide.operators.segmented import apply_log
from rowtide.plans.pipeline import run_destination

PAGES = TableContract(name="p", columns=(("id", "bigint"), ("url", "string"), ("v", "string")), primary_key=("id",), unique_keys=(("url",),), required=frozenset({"url"}), surrogate="id")
ROWS = TableContract(name="r", columns=(("k", "bigint"), ("a", "string")), primary_key=("k",))
DDL = "seq long, action string, data map<string,string>, restriction map<string,string>"


def run(spark, contract, base, log, **kw):
    res = apply_log(spark.createDataFrame(base, contract.schema), spark.createDataFrame(log, DDL), contract, **kw)
    out = {r.seq: (r.outcome, r.reason) for r in res.outcomes.collect()}
    assert res.outcomes.count() == len(log)
    return sorted(tuple(r) for r in res.table.collect()), out


def replay(base, log):
    """One packet after the other; ids of new rows are given by seq over the rows that are created."""
    rows, out, new = {r[0]: list(r[1:]) for r in base}, {}, []

    def owner(url):
        return next((k for k, r in rows.items() if r[0] == url and url is not None), None)

    for seq, action, data, restr in sorted(log):
        data = data or {}
        key = data.get("id") if action in ("add", "set") else restr.get("id")
        k = int(key) if key is not None else None
        if action == "set" and k is None:
            k = owner(data["url"])
        here = k is not None and k in rows
        if action == "delete":
            out[seq] = "deleted" if rows.pop(k, None) else "noop"
        elif action == "update" and "id" in data and int(data["id"]) != k:
            n = int(data["id"])
            if not here:
                out[seq] = "noop"
            elif n in rows or owner(data["url"]) not in (None, k):
                out[seq] = "quarantined"
            else:
                rows.pop(k)
                rows[n] = [data["url"], data["v"]]
                out[seq] = "updated"
        elif action == "add" and here:
            out[seq] = "rejected"
        elif action in ("add", "set") and not here:
            if "url" not in data or owner(data["url"]) is not None:
                out[seq] = "rejected"
            else:
                if k is None:
                    k = ("new", seq)
                    new.append(k)
                rows[k] = [data["url"], data.get("v")]
                out[seq] = "inserted"
        elif not here:
            out[seq] = "noop"
        elif "url" in data and owner(data["url"]) not in (None, k):
            out[seq] = "quarantined"
        else:
            rows[k] = [data.get("url", rows[k][0]), data.get("v", rows[k][1])]
            out[seq] = "updated"
    top = max((r[0] for r in base), default=0)
    ids = {k: top + 1 + i for i, k in enumerate(sorted(new))}
    return sorted((ids.get(k, k), *r) for k, r in rows.items()), out


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_keys_and_moves_by_replay(spark, seed):
    rng = random.Random(seed)
    base = [(i, f"u{i}", "b") for i in range(1, 8)]
    log = []
    for seq in range(1, 160):
        url, k = f"u{rng.randint(1, 25)}", str(rng.randint(1, 12))
        kind = rng.choice(["add", "add_key", "set", "set_key", "update", "delete", "move", "move"])
        log.append({
            "add": (seq, "add", {"url": url, "v": f"a{seq}"}, None),
            "add_key": (seq, "add", {"id": k, "url": url}, None),
            "set": (seq, "set", {"url": url, "v": f"s{seq}"}, None),
            "set_key": (seq, "set", {"id": k, "v": f"k{seq}"} | ({"url": url} if rng.random() < 0.5 else {}), None),
            "update": (seq, "update", {"v": f"p{seq}"} | ({"url": url} if rng.random() < 0.5 else {}), {"id": k}),
            "delete": (seq, "delete", None, {"id": k}),
            "move": (seq, "update", {"id": str(rng.randint(1, 12)), "url": url, "v": f"m{seq}"}, {"id": k}),
        }[kind])
    # ids of this log's new rows start above the base; keyed packets stay below, so both rules name the same rows
    base = [*base, (1000, "u1000", "b")]
    table, out = run(spark, PAGES, base, log)
    want_table, want = replay(base, log)
    assert {s: o for s, (o, _) in out.items()} == want
    assert table == want_table


def test_reported_cases(spark):
    table, out = run(spark, PAGES, [(1, "a", None)], [(1, "add", {"url": "b"}, None), (2, "set", {"url": "c"}, None), (3, "add", {"id": "9", "url": "a"}, None), (4, "add", {"url": "a"}, None)])
    assert table == [(1, "a", None), (2, "b", None), (3, "c", None)] and out[3] == out[4] == ("rejected", "duplicate_unique")
    table, out = run(spark, PAGES, [(1, "a", None)], [(1, "update", {"url": "b"}, {"id": "1"}), (2, "set", {"url": "a", "v": "n"}, None)])
    assert table == [(1, "b", None), (2, "a", "n")]


def test_moves_chain_swap_and_ghost(spark):
    base = [(1, "one"), (3, "three"), (5, "five")]
    move = lambda s, a, b, v: (s, "update", {"k": str(b), "a": v}, {"k": str(a)})
    table, out = run(spark, ROWS, base, [move(1, 9, 2, "ghost"), move(2, 3, 2, "three"), move(3, 1, 5, "one"), move(4, 5, 6, "five"), move(5, 1, 5, "one"), move(6, 6, 1, "five"), (7, "update", {"k": "8"}, {"k": "1"})])
    assert table == [(2, "three"), (5, "one"), (8, "five")]  # the last move names the key only: the other columns follow
    assert {s: o for s, (o, _) in out.items()} == {1: "noop", 2: "updated", 3: "quarantined", 4: "updated", 5: "updated", 6: "updated", 7: "updated"}


def test_shared_seq_has_no_order(spark):
    table, out = run(spark, ROWS, [], [(1, "add", {"k": "1"}, None), (2, "add", {"k": "2"}, None)])
    assert len(table) == 2
    log = [(1, "add", {"k": "1"}, None), (1, "add", {"k": "2"}, None), (2, "add", {"k": "3"}, None), (None, "add", {"k": "4"}, None)]
    res = apply_log(spark.createDataFrame([], ROWS.schema), spark.createDataFrame(log, DDL), ROWS)
    assert sorted((r.seq or 0, r.outcome, r.reason) for r in res.outcomes.collect()) == [(0, "quarantined", "missing_seq"), (1, "quarantined", "duplicate_seq"), (1, "quarantined", "duplicate_seq"), (2, "inserted", None)]


def test_barriers_keep_every_packet(spark):
    c = TableContract(name="b", columns=(("k", "bigint"), ("g", "string"), ("p", "bigint")), primary_key=("k",), foreign_keys=(ForeignKey(("p",), ("id",), "parent"),))
    parents = {"parent": spark.createDataFrame([(1,)], "id long")}
    log = [(None, "add", {"k": "9"}, None), (1, "update", {"p": "99"}, {"g": "a"}), (2, "update", {"p": "1"}, {"g": "a"}), (3, "add", {"k": "2", "g": "b"}, None), (4, "delete", None, {"g": None}), (5, "update", {"k": "7", "g": "c", "p": "1"}, {"k": "2"}), (6, "delete", None, {"g": "c"}), (7, "merge", {}, None)]
    table, out = run(spark, c, [(1, "a", None), (5, None, None)], log, parents=parents)
    assert table == [(1, "a", 1), (5, None, None)]
    assert out == {None: ("quarantined", "missing_seq"), 1: ("quarantined", "foreign_key"), 2: ("updated", None), 3: ("inserted", None), 4: ("noop", None), 5: ("updated", None), 6: ("deleted", None), 7: ("quarantined", "unknown_action")}


def test_more_barriers_than_any_cap(spark):
    log = [(i, "update", {"a": f"x{i}"}, {"a": f"x{i - 1}"}) for i in range(1, 8)]
    assert run(spark, ROWS, [(1, "x0")], log)[0] == [(1, "x7")]


def test_partial_keys_count_rows_once_and_targets_stay_apart(spark):
    c = TableContract(name="l", columns=(("o", "bigint"), ("n", "bigint"), ("t", "string")), primary_key=("o", "n"))
    log = [(1, "set", {"o": "1", "n": "1", "t": "a"}, None), (2, "set", {"o": "1", "n": "1", "t": "b"}, None), (3, "update", {"t": "c"}, {"o": "1"})]
    res = apply_log(spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], c.schema), spark.createDataFrame(log, DDL), c)
    assert res.outcomes.where("seq = 3").first()["rows"] == 2 and res.effects.where("seq = 3").count() == 2
    bases = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], "target string, o long, n long, t string")
    fanned = spark.createDataFrame([(s, *p, t) for t in ("a", "b") for s, p in ((1, ("set", {"o": "1", "t": "z"}, None)), (2, ("delete", None, {"o": "1"})))], DDL + ", target string")
    got = {(r.target, r.seq): (r.outcome, r["rows"]) for r in apply_targets(bases, fanned, c).outcomes.collect()}
    assert got == {("a", 1): ("updated", 2), ("a", 2): ("deleted", 2), ("b", 1): ("rejected", 0), ("b", 2): ("noop", 0)}


def test_defaults_of_the_packet_reach_the_replicas(spark):
    c = TableContract(name="d", columns=(("k", "bigint"), ("at", "string")), primary_key=("k",), defaults={"at": F.col("ts")})
    packets = spark.createDataFrame([(1, "add", {"k": "1"}, None, "noon"), (2, "set", {"k": "1"}, None, "later")], DDL + ", ts string")
    routes = spark.createDataFrame([("d", "r", "q", "t", True)], "destination string, target string, queue string, table_name string, enabled boolean")
    bases = spark.createDataFrame([], "target string, k long, at string")
    res = run_destination(spark.createDataFrame([], c.schema), packets, routes, c, "d", bases)
    assert [tuple(r) for r in res.destination.table.collect()] == [(1, "noon")]
    assert [tuple(r) for r in res.targets.table.select("k", "at").collect()] == [(1, "noon")]
    assert res.forwarded.where("seq = 1").first()["data"] == {"k": "1", "at": "noon"}


def test_only_packets_on_keys_that_moves_name_are_replayed(spark, monkeypatch):
    """every packet of a log with key moves was replayed one by one."""
    from rowtide.operators import apply

    decided = []

    def spy(*args):
        decided.append(real(*args))
        return decided[-1]

    real = apply.decide
    monkeypatch.setattr(apply, "decide", spy)
    log = [
        (1, "update", {"k": "11"}, {"k": "1"}), (2, "update", {"a": "m"}, {"k": "11"}), (3, "update", {"a": "lost"}, {"k": "1"}),
        (4, "delete", None, {"k": "2"}), (5, "add", {"k": "2", "a": "again"}, None), (6, "update", {"a": "x"}, {"k": "3"}),
        (7, "add", {"k": "3", "a": "no"}, None), (8, "set", {"k": "4", "a": "new"}, None), (9, "update", {"a": "none"}, {"k": "5"}),
    ]
    rows, out = run(spark, ROWS, [(1, "a"), (2, "b"), (3, "c")], log)
    assert rows == [(2, "again"), (3, "x"), (4, "new"), (11, "m")]
    kinds = {s: o for s, (o, _) in out.items()}
    assert kinds == {1: "updated", 2: "updated", 3: "noop", 4: "deleted", 5: "inserted", 6: "updated", 7: "rejected", 8: "inserted", 9: "noop"}
    assert out[7][1] == "duplicate_key"
    assert sorted(r["__pid"] for r in decided[0].collect()) == ["1", "2", "3"]


def test_moves_that_share_a_seq_move_nothing(spark):
    log = [(1, "update", {"k": "11"}, {"k": "1"}), (1, "update", {"k": "11"}, {"k": "1"}), (2, "update", {"a": "m"}, {"k": "2"})]
    res = apply_log(spark.createDataFrame([(1, "a"), (2, "b")], ROWS.schema), spark.createDataFrame(log, DDL), ROWS)
    assert sorted(tuple(r) for r in res.table.collect()) == [(1, "a"), (2, "m")]

"""The windowed fold against a sequential replay, on seeded random logs (absent vs NULL, unknown
columns, rejects, halts, re-inserts), with tiny seq buckets so the chunked prefix scan is exercised."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.apply import PacketHalt, apply_changes
from tests.replay import replay

C = TableContract(
    name="t",
    columns=(("k", "bigint"), ("v", "double"), ("s", "string")),
    primary_key=("k",),
    required=frozenset({"v"}),
    defaults={"s": "D"},
)


def random_log(seed: int, n: int, keys: int):
    rnd = random.Random(seed)
    packets = []
    seq = 0
    for _ in range(n):
        seq += rnd.randint(1, 3)
        a = rnd.choice(["add", "set", "update", "delete", "set", "add"])
        k = rnd.randint(0, keys)
        data = {}
        if rnd.random() < 0.8:
            data["v"] = None if rnd.random() < 0.08 else round(rnd.uniform(0, 100), 2)
        if rnd.random() < 0.5:
            data["s"] = None if rnd.random() < 0.2 else f"S{rnd.randint(0, 4)}"
        if rnd.random() < 0.1:
            data["junk"] = "x"
        if a in ("add", "set"):
            data["k"] = k
            packets.append({"seq": seq, "action": a, "data": data})
        elif a == "update":
            if not any(c in data for c in ("v", "s")):
                data["v"] = 1.0
            packets.append({"seq": seq, "action": a, "data": data, "restriction": {"k": k}})
        else:
            packets.append({"seq": seq, "action": a, "restriction": {"k": k}})
    return packets


def to_df(spark, packets):
    def m(d):
        return None if d is None else {a: (None if b is None else str(b)) for a, b in d.items()}

    rows = [(p["seq"], p["action"], m(p.get("data")), m(p.get("restriction"))) for p in packets]
    return spark.createDataFrame(rows, "seq bigint, action string, data map<string,string>, restriction map<string,string>")


@pytest.mark.parametrize("seed,span", [(1, 1 << 20), (2, 4), (3, 16), (4, 1)])
def test_fold_equals_sequential_replay(spark, seed, span):
    base_rows = {k: {"k": k, "v": float(k), "s": "B"} for k in range(0, 12, 2)}
    packets = random_log(seed, 400, 15)
    base = spark.createDataFrame([(r["k"], r["v"], r["s"]) for r in base_rows.values()], C.schema)
    res = apply_changes(base, to_df(spark, packets), C, span=span, broadcast_bytes=0 if seed % 2 else 1 << 20)
    want_table, want_out = replay(base_rows, packets, "k", {"v"}, {"s": "D"}, ["k", "v", "s"])
    got = {r["k"]: {"k": r["k"], "v": r["v"], "s": r["s"]} for r in res.table.collect()}
    assert got == want_table
    got_out = {r["seq"]: r["outcome"] for r in res.outcomes.collect()}
    assert got_out == want_out


def test_hot_key_is_split_across_buckets(spark):
    """One key holding most of the log: with span=8 no window partition exceeds 8 packets."""
    packets = random_log(7, 300, 0)  # every packet on key 0
    res = apply_changes(spark.createDataFrame([], C.schema), to_df(spark, packets), C, span=8)
    want_table, want_out = replay({}, packets, "k", {"v"}, {"s": "D"}, ["k", "v", "s"])
    assert {r["k"]: r.asDict() for r in res.table.collect()} == want_table
    assert {r["seq"]: r["outcome"] for r in res.outcomes.collect()} == want_out
    biggest = res.effects.withColumn("b", F.expr("seq div 8")).groupBy("k", "b").count().agg(F.max("count")).first()[0]
    assert biggest <= 8


def test_on_error_fail_raises(spark):
    base = spark.createDataFrame([(1, 1.0, "B")], C.schema)
    bad = to_df(spark, [{"seq": 1, "action": "update", "data": {"v": None}, "restriction": {"k": 1}}])
    with pytest.raises(PacketHalt):
        apply_changes(base, bad, C, on_error="fail")
    assert apply_changes(base, bad, C).outcomes.first()["outcome"] == "quarantined"

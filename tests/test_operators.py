"""Operators on small frames: partial keys, allocation, profiling, capture round trip, stats."""

from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.apply import apply_changes
from rowtide.operators.keys import profile_keys, rank_by_seq
from rowtide.operators.stats import counter_deltas, recent, sample_stats
from rowtide.sources.capture import capture_changes, capture_diff
from tests.test_fold import to_df

L = TableContract(
    name="lines", columns=(("o", "bigint"), ("n", "int"), ("t", "double")), primary_key=("o", "n"), required=frozenset({"t"})
)


def test_partial_key_packets_hit_rows_live_at_their_time(spark):
    base = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.2), (2, 1, 0.3)], L.schema)
    packets = to_df(spark, [
        {"seq": 1, "action": "set", "data": {"o": 1, "n": 3, "t": 0.5}},      # insert line 3 of order 1
        {"seq": 2, "action": "set", "data": {"o": 1, "t": 9.0}},              # all lines of order 1
        {"seq": 3, "action": "delete", "restriction": {"o": 2}},              # order 2 gone
        {"seq": 4, "action": "set", "data": {"o": 2, "t": 1.0}},              # nothing live: rejected
        {"seq": 5, "action": "update", "data": {"t": 7.0}, "restriction": {"n": 1}},  # line 1 of any order
    ])
    res = apply_changes(base, packets, L)
    got = sorted((r["o"], r["n"], r["t"]) for r in res.table.collect())
    assert got == [(1, 1, 7.0), (1, 2, 9.0), (1, 3, 9.0)]
    out = {r["seq"]: (r["outcome"], r["rows"]) for r in res.outcomes.collect()}
    assert out[2] == ("updated", 3) and out[3] == ("deleted", 1) and out[4][0] == "rejected" and out[5] == ("updated", 1)


def test_rank_by_seq_is_dense_across_buckets(spark):
    df = spark.createDataFrame([(s,) for s in range(0, 3000, 7)], "seq bigint")
    got = [r["rank"] for r in rank_by_seq(df, span=64, broadcast_bytes=0).orderBy("seq").collect()]
    assert got == list(range(1, len(got) + 1))


def test_profile_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a bigint, b bigint")
    got = {r["candidate"]: (r["rows"], r["null_rows"], r["duplicate_groups"], r["is_key"]) for r in profile_keys(df, [("a", "b"), ("b",)]).collect()}
    assert got == {"a,b": (4, 1, 1, False), "b": (4, 0, 1, False)}


def test_capture_diff_then_apply_reproduces_new(spark):
    c = TableContract(name="x", columns=(("id", "bigint"), ("v", "string")), primary_key=("id",))
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], c.schema)
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d"), (5, None)], c.schema)
    packets = capture_changes(capture_diff(old, new, c), c)
    got = sorted(tuple(r) for r in apply_changes(old, packets, c).table.collect())
    assert got == sorted(tuple(r) for r in new.collect())


def test_stats_deltas_and_recent(spark):
    rows = [("w", f"2024-01-01 00:00:{s:02d}", "add", "inserted") for s in range(0, 50)]
    df = spark.createDataFrame(rows, "worker string, ts string, action string, outcome string").withColumn("ts", F.to_timestamp("ts"))
    samples = sample_stats(df, "10 seconds")
    assert [r["add"] for r in samples.orderBy("sample_ts").collect()] == [10, 20, 30, 40, 50]
    d = counter_deltas(samples)
    assert [r["add"] for r in d.orderBy("sample_ts").collect()] == [10, 10, 10, 10]
    assert recent(d, 2).count() == 2


def test_barrier_on_empty_table_reports_noop(spark):
    from rowtide.operators.segmented import apply_segmented

    c = TableContract(name="x", columns=(("id", "bigint"), ("g", "string"), ("v", "double")), primary_key=("id",))
    packets = to_df(spark, [
        {"seq": 1, "action": "update", "data": {"v": 1.0}, "restriction": {"g": "a"}},
        {"seq": 2, "action": "add", "data": {"id": 1, "g": "a", "v": 0.0}},
        {"seq": 3, "action": "update", "data": {"v": 2.0}, "restriction": {"g": "a"}},
        {"seq": 4, "action": "delete", "restriction": {"g": "b"}},
    ])
    res = apply_segmented(spark.createDataFrame([], c.schema), packets, c)
    out = {r["seq"]: r["outcome"] for r in res.outcomes.collect()}
    assert out == {1: "noop", 2: "inserted", 3: "updated", 4: "noop"}
    assert [tuple(r) for r in res.table.collect()] == [(1, "a", 2.0)]


def test_rank_by_seq_carries_only_seqs_through_its_window(spark):
    """seqs of one bucket sent whole rows to one task; rows that share a seq still get ranks of their own."""
    df = spark.createDataFrame([(s, "x" * s) for s in (5, 2, 9)], "seq bigint, body string")
    ranked = rank_by_seq(df)
    assert "Window" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["seq"], r["body"], r["rank"]) for r in ranked.collect()) == [(2, "xx", 1), (5, "xxxxx", 2), (9, "x" * 9, 3)]
    twice = rank_by_seq(df.unionByName(df).unionByName(spark.createDataFrame([(None, "y")], df.schema)), span=4)
    assert sorted((r["seq"], r["rank"]) for r in twice.collect()) == [(2, 1), (2, 2), (5, 3), (5, 4), (9, 5), (9, 6)]

"""What a log costs in rounds, windows and steps, and that the short ways give what the long ones do."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.contract import ForeignKey, TableContract
from rowtide.operators import apply, components, related, segmented
from rowtide.operators.fold import live_before
from rowtide.operators.prefixes import Prefixes
from rowtide.operators.segmented import apply_log
from rowtide.operators.versions import same_rows, version_intervals
from rowtide.sources.tables import bucket_of
from rowtide.streaming.stream import touched_before

PEOPLE = TableContract(name="people", columns=(("id", "bigint"), ("name", "string"), ("place", "string")), primary_key=("id",), unique_keys=(("name",),))
LINES = TableContract(name="lines", columns=(("a", "bigint"), ("b", "bigint"), ("x", "string")), primary_key=("a", "b"))
ENVELOPE = "seq bigint, action string, data map<string,string>, restriction map<string,string>"


def counted(monkeypatch, module, name):
    calls, plain = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **kw: calls.append(1) or plain(*a, **kw))
    return calls


def test_restrictions_on_rows_that_nothing_changes_take_one_round(spark, monkeypatch):
    base = spark.createDataFrame([(1, "p", "n"), (2, "q", "n"), (3, "r", "s")], PEOPLE.schema)
    log = spark.createDataFrame([(1, "delete", None, {"place": "n"}), (2, "add", {"id": "9", "name": "p", "place": "t"}, None), (3, "add", {"id": "8", "name": "r", "place": "t"}, None)], ENVELOPE)
    rounds = counted(monkeypatch, segmented, "apply_lives")
    res = apply_log(base, log, PEOPLE)
    assert len(rounds) == 1
    assert sorted(map(tuple, res.table.collect())) == [(3, "r", "s"), (9, "p", "t")]
    assert {r["seq"]: r["outcome"] for r in res.outcomes.collect()} == {1: "deleted", 2: "inserted", 3: "rejected"}


def test_a_wrong_first_guess_is_mended(spark):
    """The base rows that the restriction names have moved on by its packet, and another one has come."""
    base = spark.createDataFrame([(1, "p", "n"), (2, "q", "s")], PEOPLE.schema)
    log = spark.createDataFrame([(1, "update", {"place": "s"}, {"id": "1"}), (2, "update", {"place": "n"}, {"name": "q"}), (3, "delete", None, {"place": "n"}), (4, "delete", None, {"place": "none"})], ENVELOPE)
    res = apply_log(base, log, PEOPLE)
    assert sorted(map(tuple, res.table.collect())) == [(1, "p", "s")]
    assert {r["seq"]: r["outcome"] for r in res.outcomes.collect()} == {1: "updated", 2: "updated", 3: "deleted", 4: "noop"}


def test_same_rows_counts(spark):
    a, b = (spark.createDataFrame(rows, "s bigint, k string") for rows in ([(1, None), (1, None), (2, "x")], [(1, None), (2, "x"), (2, "x")]))
    assert same_rows(a, a) and not same_rows(a, b) and not same_rows(a.distinct(), a)


def test_stars_are_components_already(spark, monkeypatch):
    written = counted(monkeypatch, components, "materialize")
    links = spark.createDataFrame([(9, 1), (8, 1), (7, 2)], "u long, v long").coalesce(1)
    found = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert found == {9: 1, 8: 1, 1: 1, 7: 2, 2: 2} and len(written) == 1


def _effects(spark, n=300):
    rng = random.Random(5)
    rows = [(rng.randrange(20), s, rng.choice(["ins", "del", "upd", "upd"])) for s in range(n)]
    return spark.createDataFrame(rows, "k bigint, seq bigint, cls string"), spark.createDataFrame([(k,) for k in range(0, 25, 2)], "k bigint")


def test_live_before_in_one_window(spark):
    effects, base = _effects(spark)
    short, long = live_before(effects, base, ["k"], 300, True), live_before(effects, base, ["k"], 16)
    cols = ["k", "seq", "live_before", "b_live"]
    assert sorted(map(tuple, short.select(*cols).collect())) == sorted(map(tuple, long.select(*cols).collect()))
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate" not in plan


@pytest.mark.parametrize("span", [1, 7])
def test_versions_in_one_window(spark, span):
    effects, base = _effects(spark)
    contract = TableContract(name="t", columns=(("k", "bigint"), ("v", "string")), primary_key=("k",))
    live = F.col("live_before")
    outcome = F.when((F.col("cls") == "ins") & ~live, "inserted").when(~live, "noop").when(F.col("cls") == "del", "deleted").otherwise("updated")
    folded = live_before(effects, base, ["k"]).withColumns({"outcome": outcome, "dp__v": F.col("seq") % 3 != 0, "d__v": F.when(F.col("seq") % 5 != 0, F.col("seq").cast("string"))})
    rows = base.withColumn("v", F.lit("old"))
    short, long = version_intervals(rows, folded, contract, ["v"]), version_intervals(rows, folded, contract, ["v"], span)
    cols = ["k", "v", "lo", "hi"]
    assert sorted(map(repr, short.select(*cols).collect())) == sorted(map(repr, long.select(*cols).collect()))


def test_parts_of_keys_with_and_without_chunks(spark, monkeypatch):
    rng = random.Random(11)
    base = spark.createDataFrame([(a, b, "o") for a in range(6) for b in range(4)], LINES.schema)
    log = []
    for s in range(120):
        a, b = str(rng.randrange(8)), str(rng.randrange(6))
        log.append(rng.choice([
            (s, "set", {"a": a, "b": b, "x": f"s{s}"}, None), (s, "delete", None, {"a": a, "b": b}), (s, "delete", None, {"a": a}),
            (s, "update", {"x": f"p{s}"}, {"a": a}), (s, "set", {"b": b, "x": f"q{s}"}, None),
        ]))
    packets = spark.createDataFrame(log, ENVELOPE)
    counts = counted(monkeypatch, Prefixes, "counts")
    got = [apply.apply_changes(base, packets, LINES, span=span) for span in (1 << 20, 3)]
    tables = [sorted(map(tuple, r.table.collect())) for r in got]
    assert not counts  # only outcomes ask how many rows a packet hits
    outcomes = [sorted(map(repr, r.outcomes.select("seq", "outcome", "reason", "rows").collect())) for r in got]
    hits = [sorted(map(repr, r.effects.select("seq", "a", "b", "outcome").collect())) for r in got]
    assert tables[0] == tables[1] and outcomes[0] == outcomes[1] and hits[0] == hits[1] and len(outcomes[0]) == len(log)


def test_answers_that_whole_keys_give_take_one_round(spark, monkeypatch):
    """Document 2 is kept by its label, document 1 is deleted before its label comes, document 3 has none, document 4 is made late."""
    docs = TableContract(name="docs", columns=(("id", "bigint"), ("lang", "string")), primary_key=("id",))
    labels = TableContract(name="labels", columns=(("label", "bigint"), ("id", "bigint")), primary_key=("label",))
    parents = spark.createDataFrame([(2, "delete", None, {"id": "1"}), (4, "delete", None, {"id": "2"}), (5, "delete", None, {"id": "3"}), (9, "add", {"id": "4", "lang": "x"}, None)], ENVELOPE)
    children = spark.createDataFrame([(1, "add", {"label": "20", "id": "2"}, None), (3, "add", {"label": "10", "id": "1"}, None), (8, "add", {"label": "40", "id": "4"}, None), (10, "add", {"label": "41", "id": "4"}, None)], ENVELOPE)
    calls = counted(monkeypatch, related, "apply_log")
    base = spark.createDataFrame([(k, "x") for k in (1, 2, 3)], docs.schema)
    res = related.apply_related(base, spark.createDataFrame([], labels.schema), parents, children, docs, labels, ForeignKey(("id",), ("id",), "docs"))
    assert len(calls) == 2  # each table once
    assert sorted(map(tuple, res.child.table.collect())) == [(20, 2), (41, 4)]
    assert sorted(r["id"] for r in res.parent.table.collect()) == [2, 4]
    reasons = {r["seq"]: r["reason"] for r in res.parent.outcomes.unionByName(res.child.outcomes, allowMissingColumns=True).collect()}
    assert reasons == {1: None, 2: None, 3: "foreign_key", 4: "restrict", 5: None, 8: "foreign_key", 9: None, 10: None}


def test_buckets_of_a_micro_batch(spark):
    docs = TableContract(name="docs", columns=(("id", "bigint"), ("lang", "string")), primary_key=("id",))
    whole = [(1, "add", {"id": "1"}, None), (2, "delete", None, {"id": "7"}), (3, "merge", {"id": "5"}, None), (4, "set", {"id": "n/a"}, None)]
    want = sorted(r[0] for r in spark.createDataFrame([(1,), (7,)], "id bigint").select(bucket_of(["id"], 64)).distinct().collect())
    assert sorted(touched_before(spark.createDataFrame(whole, ENVELOPE), docs, 64, ["id"])) == want
    assert touched_before(spark.createDataFrame([*whole, (5, "delete", None, {"lang": "x"})], ENVELOPE), docs, 64, ["id"]) is None
    assert touched_before(spark.createDataFrame([], ENVELOPE), docs, 64, ["id"]) == []

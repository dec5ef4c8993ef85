"""Stream = batch, late packets apply when they arrive, a restart re-applies nothing, replicas follow."""

import tempfile

from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.apply import apply_changes
from rowtide.sources.packets import encode_packets, write_packets
from rowtide.sources.tables import current_mark, read_snapshot
from rowtide.streaming.stream import stream_destination
from tests.test_fold import random_log, to_df

C = TableContract(
    name="t", columns=(("k", "bigint"), ("v", "double"), ("s", "string")), primary_key=("k",),
    required=frozenset({"v"}), defaults={"s": "D"},
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_applies_late_packets(spark):
    d = tempfile.mkdtemp(prefix="rowtide-stream-")
    src, root, ckpt = f"{d}/src", f"{d}/table", f"{d}/ckpt"
    packets = to_df(spark, random_log(11, 300, 20))
    base = spark.createDataFrame([(1, 1.0, "B"), (2, 2.0, "B")], C.schema)
    lo, hi = 0, 2000
    cut = [lo, 200, 400, hi]
    for a, b in zip(cut, cut[1:]):
        write_packets(encode_packets(packets.where((F.col("seq") >= a) & (F.col("seq") < b))), src)
        stream_destination(spark, src, base, C, root, ckpt, max_files_per_trigger=None).awaitTermination()
    want = _rows(apply_changes(base, packets, C).table)
    assert _rows(read_snapshot(spark, root)) == want

    # a restart with nothing new changes nothing
    stream_destination(spark, src, base, C, root, ckpt, max_files_per_trigger=None).awaitTermination()
    assert _rows(read_snapshot(spark, root)) == want

    # packets older than the last applied seq arrive late: applied to the table as it is now, together with newer ones
    late = packets.where(F.col("seq") < 50).unionByName(spark.createDataFrame([(5000, "set", {"k": "77", "v": "7.0"}, None)], packets.select("seq", "action", "data", "restriction").schema), allowMissingColumns=True)
    write_packets(encode_packets(late), src)
    stream_destination(spark, src, base, C, root, ckpt, max_files_per_trigger=None).awaitTermination()
    then = read_snapshot(spark, root)
    assert (77, 7.0, "D") in _rows(then)
    assert _rows(then) == _rows(apply_changes(spark.createDataFrame(want, C.schema), late, C).table)

    # a new stream on the same table goes on from its current version
    write_packets(encode_packets(packets.where(F.col("seq") < 0).unionByName(late.where("seq = 5000").withColumn("seq", F.lit(1).cast("long")).withColumn("action", F.lit("delete")).withColumn("data", F.lit(None).cast("map<string,string>")).withColumn("restriction", F.create_map(F.lit("k"), F.lit("77"))))), f"{d}/src2")
    stream_destination(spark, f"{d}/src2", base, C, root, f"{d}/ckpt2", max_files_per_trigger=None).awaitTermination()
    assert _rows(read_snapshot(spark, root)) == [r for r in _rows(then) if r[0] != 77]


def test_stream_forwards_to_replicas(spark):
    d = tempfile.mkdtemp(prefix="rowtide-stream-")
    routes = spark.createDataFrame([("t", "a", "q", "t", True), ("t", "b", "q", "t", False)], "destination string, target string, queue string, table_name string, enabled boolean")
    base = spark.createDataFrame([(1, 1.0, "B")], C.schema)
    log = [(1, "add", {"k": "2", "v": "2"}, None), (2, "add", {"k": "1", "v": "9"}, None), (3, "update", {"v": "5"}, {"k": "1"})]
    for i, row in enumerate(log):
        write_packets(encode_packets(spark.createDataFrame([row], "seq long, action string, data map<string,string>, restriction map<string,string>")), f"{d}/src")
        stream_destination(spark, f"{d}/src", base, C, f"{d}/t", f"{d}/c", max_files_per_trigger=None, routes=routes, destination="t", target_bases=spark.createDataFrame([], "target string, k long, v double, s string")).awaitTermination()
    assert _rows(read_snapshot(spark, f"{d}/t")) == [(1, 5.0, "B"), (2, 2.0, "D")]
    assert [tuple(r) for r in read_snapshot(spark, f"{d}/t/_targets").select("target", "k", "v").collect()] == [("a", 2, 2.0)]
    sent = spark.read.option("basePath", f"{d}/t/_queues").text(f"{d}/t/_queues/*")
    assert sorted((r.target, r.value[:8]) for r in sent.collect()) == [("a", '{"seq":1'), ("a", '{"seq":3'), ("b", '{"seq":1'), ("b", '{"seq":3')]


DDL = "seq long, action string, data map<string,string>, restriction map<string,string>"
ROUTE_DDL = "destination string, target string, queue string, table_name string, enabled boolean"


def _send(spark, d, log, **kw):
    write_packets(encode_packets(spark.createDataFrame(log, DDL)), f"{d}/src")
    q = stream_destination(spark, f"{d}/src", spark.createDataFrame([(i, float(i), "B") for i in range(400)], C.schema), C, f"{d}/t", f"{d}/c", max_files_per_trigger=None, **kw)
    if q is not None:
        q.awaitTermination()


def test_a_batch_writes_the_buckets_it_touches(spark):
    import glob

    d = tempfile.mkdtemp(prefix="rowtide-stream-")
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/table-*"))
    log = [(1, "update", {"v": "-1"}, {"k": "7"}), (2, "delete", None, {"k": "8"}), (3, "add", {"k": "1000", "v": "1"}, None), (4, "update", {"v": "0"}, {"k": "5000"})]
    _send(spark, d, log)
    mark = current_mark(spark, f"{d}/t")
    assert mark.version == 1 and sum(v == 1 for v in mark.buckets) <= 4 and sum(v == 0 for v in mark.buckets) >= 60
    assert len(glob.glob(f"{d}/t/data/v=1/__bucket=*")) <= 4
    want = {i: float(i) for i in range(400)} | {7: -1.0, 1000: 1.0}
    del want[8]
    assert {r.k: r.v for r in read_snapshot(spark, f"{d}/t").collect()} == want
    # a restriction on another column reads the whole table and writes the buckets of the rows it hits
    _send(spark, d, [(10, "update", {"s": "x"}, {"v": "3"}), (11, "delete", None, {"v": "4"})])
    mark = current_mark(spark, f"{d}/t")
    assert mark.version == 2 and sum(v == 2 for v in mark.buckets) in (1, 2)
    del want[4]
    assert {r.k: r.v for r in read_snapshot(spark, f"{d}/t").collect()} == want
    # a key move and the removal of all rows
    _send(spark, d, [(20, "update", {"k": "2000"}, {"k": "7"})])
    assert {r.k: r.v for r in read_snapshot(spark, f"{d}/t").collect()} == {2000 if k == 7 else k: v for k, v in want.items()}
    _send(spark, d, [(30 + i, "delete", None, {"k": str(k)}) for i, k in enumerate([*(k for k in want if k != 7), 2000])])
    assert read_snapshot(spark, f"{d}/t").collect() == [] and set(current_mark(spark, f"{d}/t").buckets) == {-1}
    assert set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/table-*")) <= before


def test_targets_catch_up_from_their_own_offset(spark):
    d = tempfile.mkdtemp(prefix="rowtide-stream-")

    def routes(**enabled):
        return spark.createDataFrame([("t", t, "q", "t", on) for t, on in enabled.items()], ROUTE_DDL)

    kw = {"destination": "t", "target_bases": spark.createDataFrame([], "target string, k long, v double, s string")}
    _send(spark, d, [(1, "add", {"k": "1000", "v": "2"}, None)], routes=routes(a=True, b=False), **kw)
    _send(spark, d, [(2, "add", {"k": "1001", "v": "3"}, None), (3, "add", {"k": "5", "v": "0"}, None)], routes=routes(a=True, b=False), **kw)

    def rows():
        return sorted(tuple(r)[:3] for r in read_snapshot(spark, f"{d}/t/_targets").collect())

    assert rows() == [("a", 1000, 2.0), ("a", 1001, 3.0)]
    assert current_mark(spark, f"{d}/t/_targets").offsets == {"a": 2}
    _send(spark, d, [(4, "update", {"v": "9"}, {"k": "1000"})], routes=routes(a=False, b=True), **kw)
    assert rows() == [("a", 1000, 2.0), ("a", 1001, 3.0), ("b", 1000, 9.0), ("b", 1001, 3.0)]
    _send(spark, d, [(5, "delete", None, {"k": "1001"})], routes=routes(a=True, b=True), **kw)
    assert rows() == [("a", 1000, 9.0), ("b", 1000, 9.0)]
    assert current_mark(spark, f"{d}/t/_targets").offsets == {"a": 4, "b": 4}
    version = current_mark(spark, f"{d}/t").version
    _send(spark, d, [(6, "delete", None, {"k": "1000"})], routes=routes(a=True, b=True), destination_enabled=False, **kw)
    assert current_mark(spark, f"{d}/t").version == version and len(rows()) == 2

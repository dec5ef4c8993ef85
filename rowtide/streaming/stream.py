"""Continuous destination: a packet stream applied micro-batch by micro-batch with ``foreachBatch``.

State is the table itself: a micro-batch reads the current snapshot and commits the next version, which holds the buckets
that it changes (:mod:`rowtide.sources.tables`). The commit marker names the stream (its checkpoint folder) and the batch, so
a replayed batch that was committed is skipped, one that wasn't is written again, and a new stream goes on from the
current version. Arrival order is the truth: batches apply in order of arrival, packets inside a batch in order of seq; a
packet with a smaller seq than an earlier batch's applies late, not never.

With routes, every version also forwards its accepted packets to queues, one folder per version and target. Each target
has an offset of its own, the last version that it applied; a target that was disabled goes on from there when it is
enabled again. A disabled destination starts nothing. Scratch tables of a micro-batch are removed after its commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.contract import TableContract
from rowtide.operators.align import prepare
from rowtide.operators.apply import ChangeResult, is_move
from rowtide.operators.distribute import TARGET, accepted, apply_targets, enabled_targets, fan_out, target_contract
from rowtide.operators.segmented import apply_log
from rowtide.session import materialize, scratch_scope
from rowtide.sources.packets import encode_packets, parse_packets, read_packets
from rowtide.sources.tables import BUCKETS, Mark, applied, bucket_of, current_mark, current_version, read_snapshot, write_snapshot


def touched_before(packets: DataFrame, contract: TableContract, buckets: int, key: list[str]) -> list[int] | None:
    """Buckets that a log of whole-key packets can touch, known before it is applied (at most ``buckets`` rows); else None."""
    if contract.unique_keys or contract.surrogate:
        return None
    p = prepare(packets, contract)
    fine = F.col("reject_reason").isNull()
    other = F.coalesce(fine & (F.col("match_kind") != "pk") | is_move(contract), F.lit(False))
    named = p.select(fine.alias("__fine"), other.alias("__other"), *[F.when(F.col("action").isin("add", "set"), F.col(f"d__{k}")).otherwise(F.col(f"r__{k}")).alias(k) for k in key])
    seen = named.agg(F.max("__other").alias("other"), F.collect_set(F.when(F.col("__fine"), bucket_of(key, buckets))).alias("buckets")).first()  # the log is aligned once
    return None if seen["other"] else list(seen["buckets"])


def touched_after(res: ChangeResult, contract: TableContract, buckets: int, key: list[str], moved: bool) -> list[int] | None:
    """Buckets that the applied effects touched (at most ``buckets`` rows); None (all) where rows are known by life."""
    if contract.unique_keys or moved:
        return None
    hit = res.effects.where(F.col("outcome").isin("inserted", "updated", "deleted"))
    return [r[0] for r in hit.select(bucket_of(key, buckets)).distinct().collect()]


def stream_destination(
    spark: SparkSession,
    source_path: str,
    base: DataFrame,
    contract: TableContract,
    root: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = 1,
    available_now: bool = True,
    routes: DataFrame | None = None,
    destination: str | None = None,
    target_bases: DataFrame | None = None,
    destination_enabled: bool = True,
    buckets: int = BUCKETS,
    **kw,
) -> StreamingQuery | None:
    """Start the stream: JSON packet files at ``source_path`` -> snapshots under ``root``. None if the destination is disabled.

    ``routes`` (with ``destination`` and ``target_bases``): forwarded packets go to ``root/_queues/version=n/target=...``,
    replicas of the targets are snapshots under ``root/_targets``.
    """
    if not destination_enabled:
        return None
    root = root.rstrip("/")
    replicas, key = f"{root}/_targets", list(contract.primary_key)
    if current_version(spark, root) is None:
        write_snapshot(base.select(*contract.names), root, 0, key, buckets=buckets)
    if routes is not None and current_version(spark, replicas) is None:
        write_snapshot(target_bases.select("target", *contract.names), replicas, 0, ["target", *key], buckets=buckets)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            if not applied(spark, root, checkpoint_location, batch_id):
                advance(materialize(batch), batch_id)
            if routes is not None:
                advance_targets()

    def advance(batch: DataFrame, batch_id: int) -> None:
        mark = current_mark(spark, root)
        version = mark.version + 1
        touched = touched_before(batch, contract, len(mark.buckets), key)
        res = apply_log(read_snapshot(spark, root, mark.version, touched), batch, contract, **kw)
        if touched is None:
            moved = not prepare(batch, contract).where(is_move(contract)).isEmpty()
            touched = touched_after(res, contract, len(mark.buckets), key, moved)
        res.outcomes.drop("data", "restriction").write.mode("overwrite").parquet(f"{root}/_outcomes/v={version}")
        if routes is not None:
            sent = fan_out(accepted(res.outcomes).select("seq", "action", "data", "restriction"), routes.where(F.col("destination") == destination), destination)
            bodies = encode_packets(sent.select("target", "seq", "action", "data", "restriction")).select("target", F.col("body").alias("value"))
            bodies.write.mode("overwrite").partitionBy("target").text(f"{root}/_queues/version={version}")
        top = [x for x in (batch.agg(F.max("seq")).first()[0], mark.max_seq) if x is not None]
        write_snapshot(res.table, root, version, key, before=mark, touched=touched, max_seq=max(top, default=None), stream=checkpoint_location, batch=batch_id)

    def advance_targets() -> None:
        """Each enabled target applies the versions after its offset; targets at one offset go in one job."""
        names = [r["target"] for r in enabled_targets(routes.where(F.col("destination") == destination)).select("target").distinct().collect()]  # configuration
        last, mark = current_version(spark, root), current_mark(spark, replicas)
        for version in range(min((mark.offsets.get(t, 0) for t in names), default=last) + 1, last + 1):
            behind = [t for t in names if mark.offsets.get(t, 0) < version]
            mark = apply_queue(version, behind, mark)

    def apply_queue(version: int, names: list[str], mark: Mark) -> Mark:
        queue = f"{root}/_queues/version={version}"
        if "target" not in spark.read.text(queue).columns:  # nothing was forwarded
            mark.offsets |= dict.fromkeys(names, version)
            return mark
        lines = spark.read.schema("value string, target string").text(queue)
        packets = materialize(parse_packets(lines.where(F.col("target").isin(names)).withColumnRenamed("value", "body")))
        contract_of = target_contract(contract)
        named = packets.withColumns({p: F.map_concat(F.col(p), F.create_map(F.lit(TARGET), F.col("target"))) for p in ("data", "restriction")})
        touched = touched_before(named, contract_of, len(mark.buckets), [TARGET, *key])
        res = apply_targets(read_snapshot(spark, replicas, mark.version, touched), packets.select("seq", "action", "data", "restriction", "target"), contract, **kw)
        if touched is None:
            moved = not prepare(named, contract_of).where(is_move(contract_of)).isEmpty()
            touched = touched_after(res, contract_of, len(mark.buckets), ["target", *key], moved)
        res.outcomes.drop("data", "restriction", TARGET).write.mode("overwrite").parquet(f"{replicas}/_outcomes/v={mark.version + 1}")
        table = res.table.select("target", *contract.names)
        return write_snapshot(table, replicas, mark.version + 1, ["target", *key], before=mark, touched=touched, offsets=mark.offsets | dict.fromkeys(names, version))

    packets = read_packets(spark, source_path, streaming=True, max_files_per_trigger=max_files_per_trigger)
    writer = packets.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
    return writer.start()

"""Distribution: accepted stream, fan-out to replica queues, all replicas applied in one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.apply import ChangeResult
from rowtide.operators.segmented import apply_log
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small

# A processor turns (base, packets, contract) into a ChangeResult; the default is the fold.
Processor = Callable[..., ChangeResult]
TARGET = "__target"
ROUTES_DDL = "destination string, target string, queue string, table_name string, enabled boolean"


def accepted(outcomes: DataFrame) -> DataFrame:
    """Packets the destination forwards: all but rejected / quarantined ones.

    No-op updates and deletes are forwarded too (zero rows is success in the reference).
    """
    return outcomes.where(~F.col("outcome").isin("rejected", "quarantined"))


def fan_out(accepted_packets: DataFrame, routes: DataFrame, destination: str | None = None,
            broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One copy of each accepted packet per target of its destination (``routes``: destination, target, queue, ...).

    A disabled target still receives its copies (the reference forwards regardless), so it can
    catch up later; disabling only stops applying. ``routes`` is configuration; it is broadcast
    after its size is measured.
    """
    pk = accepted_packets
    if destination is not None:
        pk = pk.withColumn("destination", F.lit(destination))
    r = routes.select("destination", "target", "queue")
    r = broadcast_if_small(r, broadcast_bytes) if broadcast_bytes > 0 else r
    return pk.join(r, "destination")


def enabled_targets(routes: DataFrame) -> DataFrame:
    return routes.where(F.col("enabled"))


def target_contract(contract: TableContract) -> TableContract:
    """The contract with the target name prepended to the key: one fold serves every replica."""
    unique = tuple((TARGET, *uk) for uk in contract.unique_keys)  # unique within a replica
    return replace(contract, columns=((TARGET, "string"), *contract.columns), primary_key=(TARGET, *contract.primary_key), unique_keys=unique)


def apply_targets(bases: DataFrame, fanned: DataFrame, contract: TableContract, **kw) -> ChangeResult:
    """Each target applies its forwarded packets to its own replica (no further forwarding).

    ``bases``: replica rows with a ``target`` column; ``fanned``: packets with a ``target`` column.
    The target becomes the leading key column (injected into data for add/set and into the
    restriction for update/delete), so all replicas fold in one job, partitioned by (target, key).
    Replicas may start from different bases and then legitimately differ.
    """
    t = F.create_map(F.lit(TARGET), F.col("target"))
    empty = F.create_map().cast("map<string,string>")
    a = F.col("action")
    pk = fanned.withColumn(
        "data", F.when(a.isin("add", "set"), F.map_concat(F.coalesce(F.col("data"), empty), t)).otherwise(F.col("data"))
    ).withColumn(
        "restriction",
        F.when(a.isin("update", "delete"), F.map_concat(F.coalesce(F.col("restriction"), empty), t)).otherwise(F.col("restriction")),
    )
    tc = target_contract(contract)
    base = bases.select(F.col("target").alias(TARGET), *contract.names)
    # further packet columns go along: computed defaults read them
    res = apply_log(base, pk.drop("destination", "queue"), tc, **kw, identity=("target",))
    return ChangeResult(
        lambda: res.outcomes, lambda: res.effects.drop("target").withColumnRenamed(TARGET, "target"), lambda: res.table.withColumnRenamed(TARGET, "target"),
    )


def apply_each_target(
    bases: DataFrame, fanned: DataFrame, contract: TableContract, contracts: dict[str, TableContract] | None = None,
    processors: dict[str, Processor] | None = None, **kw,
) -> ChangeResult:
    """:func:`apply_targets` where targets have tables or functions of their own.

    ``contracts``: the table of a target, where it isn't ``contract``; its columns are read from the whole forwarded packet.
    ``processors``: the function of a target, with the signature of :func:`apply_log`, where it isn't the default. Targets that
    share both go in one job, so there are as many jobs as different tables and functions (configuration).
    ``bases`` holds the columns of all tables; a table's own are read from it.
    """
    contracts, processors = contracts or {}, processors or {}
    named = sorted({*contracts, *processors})
    if not named:
        return apply_targets(bases, fanned, contract, **kw)
    groups: dict[tuple, list[str]] = {}
    for t in named:
        own = t if t in processors else None  # a function sees its own target only
        groups.setdefault((id(contracts.get(t, contract)), own), []).append(t)
    rest = ~F.col("target").isin(named)
    parts = [apply_targets(bases.where(rest).select("target", *contract.names), fanned.where(rest), contract, **kw)]
    for targets in groups.values():
        table, chosen = contracts.get(targets[0], contract), F.col("target").isin(targets)
        own, packets = bases.where(chosen).select("target", *table.names), fanned.where(chosen)
        if targets[0] in processors:
            res = processors[targets[0]](own.drop("target"), packets.drop("target", "destination", "queue"), table, **kw)
            name = F.lit(targets[0])
            parts.append(ChangeResult(res.outcomes.withColumn("target", name), res.effects.withColumn("target", name), res.table.withColumn("target", name)))
        else:
            parts.append(apply_targets(own, packets, table, **kw))
    joined = [reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) for frames in zip(*[(p.outcomes, p.effects, p.table) for p in parts], strict=True)]
    return ChangeResult(*joined)

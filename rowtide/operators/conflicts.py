"""Packets that depend on one another beyond one key: unique keys and key-moving updates.

The fold carries one bit per key. A unique value ties keys together (who owns it when a packet arrives?), and so does a
key move (is the old row live, is the new key free?). Such packets are decided first:

1. Nodes are primary keys and unique values. A packet, or a base row that the log names by a key or a unique value, links
   its nodes. The connected components of these links are independent of one another.
2. The slim events of a component (keys, unique columns, fold class; no other column) are replayed in order of seq.
   Partitions are sorted and streamed; a task holds the live rows of one component, never its events.
3. The verdicts go back to the packets: the key each one hits or creates, or why it is refused, and the *life* of the row
   it hits: a row keeps its life when its key moves. Everything else (values, defaults, liveness of the other packets)
   is left to the fold.

A packet with any number of rows (a restriction on other columns or on part of the key) comes with one event per life that it
hits; only those that delete, or write a unique column or the key, are replayed. Its rows change together or not at all.

New rows get their surrogate ids in one ranked pass over all packets that create one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv, rp, rv
from rowtide.operators.components import components
from rowtide.operators.keys import allocate_keys
from rowtide.session import broadcast_if_small, materialize


def _json_key(cols: list[Column]) -> Column:
    return F.to_json(F.array(*[c.cast("string") for c in cols]), {"ignoreNullFields": "false"})


def unique_columns(contract: TableContract) -> list[str]:
    return sorted({c for uk in contract.unique_keys for c in uk})


def life_of_base(contract: TableContract) -> Column:
    """The life of a row of the base table: its key there."""
    return _json_key([F.col(k) for k in contract.primary_key])


def _nodes(keys: list[Column], contract: TableContract, value: dict[str, Column], given: dict[str, Column], last: list[Column]) -> Column:
    """Hashes of the keys and of the unique values that an event names.

    A unique key of several columns is known by its last one: two rows that ever share the whole value share that, and an
    event that writes only the other columns is tied to its row's by the row. So is the primary key where moves name only a
    part of the new one (``last``: values of its last column).
    """
    parts = [F.when(x.isNotNull(), F.xxhash64(F.lit("k"), x)) for x in keys]
    parts += [F.when(x.isNotNull(), F.xxhash64(F.lit("l"), x.cast("string"))) for x in last]
    for i, uk in enumerate(contract.unique_keys):
        c = uk[-1]
        parts.append(F.when(given[c] & value[c].isNotNull(), F.xxhash64(F.lit(f"u{i}"), value[c].cast("string"))))
    return F.array_except(F.array(*parts), F.array(F.lit(None).cast("long")))  # without the nulls, and without a lambda, which isn't compiled


_EVENT_COLUMNS = ("seq", "pid", "kind", "k", "k2", "life", "has", "vals", "new_vals", "nodes")


def _replay_map(unique: list[list[int]]):
    """The sequential rule, over events sorted by component, seq and packet; ``unique``: places of the columns of each unique key."""

    nothing = ([], [], [])  # no unique columns: the events come without their values

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        comp, rows, lives, place, owner, group = None, {}, {}, {}, [], []

        def values(row: list) -> list[str | None]:
            return [None if any(row[j] is None for j in u) else json.dumps([row[j] for j in u]) for u in unique]

        def taken(row: list, by: str | None) -> bool:
            return any(v is not None and owner[i].get(v, by) != by for i, v in enumerate(values(row)))

        def put(k: str, row: list, life: str) -> None:
            drop(k)
            rows[k], lives[k], place[life] = row, life, k
            for i, v in enumerate(values(row)):
                if v is not None:
                    owner[i][v] = k

        def drop(k: str) -> None:
            if k in rows:
                place.pop(lives.pop(k), None)
                for i, v in enumerate(values(rows.pop(k))):
                    if v is not None:
                        owner[i].pop(v, None)

        def together() -> tuple:
            """One packet's rows: all of them change, or none."""
            here = [(place[e.life], e) for e in group if e.life in place]
            old = [(k, rows[k], lives[k]) for k, _ in here]
            verdict = "go"
            for k, _ in here:
                drop(k)
            done = []
            for (k, row, life), (_, e) in zip(old, here, strict=True):
                if e.kind == "hit_delete":
                    continue
                new = [v if h else o for h, v, o in zip(e.has, e.vals, row, strict=True)] if unique else []
                key = k if e.k2 is None else json.dumps([b if a is None else a for a, b in zip(json.loads(e.k2), json.loads(k), strict=True)], separators=(",", ":"), ensure_ascii=False)
                if key in rows or taken(new, key):
                    verdict = "halt_key" if key in rows else "halt_unique"
                    break
                put(key, new, life)
                done.append(key)
            if verdict != "go":
                for k in done:
                    drop(k)
                for k, row, life in old:
                    put(k, row, life)
            return group[0].pid, verdict, None, False, None

        for frame in frames:
            out = []
            for e in frame.itertuples(index=False):
                if group and (group[0].comp, group[0].pid) != (e.comp, e.pid):
                    out.append(together())
                    group = []
                if e.comp != comp:
                    comp, rows, lives, place, owner = e.comp, {}, {}, {}, [{} for _ in unique]
                if e.kind.startswith("hit_"):
                    group.append(e)
                    continue
                has, vals, new = (list(e.has), list(e.vals), list(e.new_vals)) if unique else nothing
                k, verdict, created = e.k, "go", False
                if e.kind == "base":
                    put(k, new, k)
                    continue
                if e.kind.endswith("_unique"):  # the owner of the first unique key that is given whole
                    at = int(e.k2)
                    k = owner[at].get(values(vals)[at])
                here = k is not None and k in rows
                life = lives[k] if here else None
                merged = [v if h else o for h, v, o in zip(has, vals, rows[k], strict=True)] if here else None
                if e.kind in ("look", "probe_unique"):
                    pass
                elif e.kind in ("add", "set", "set_unique") and not here:
                    if taken(new, k):
                        verdict = "duplicate_unique"
                    else:
                        created = k is None
                        k, life = k or f"new:{e.pid}", f"n:{e.pid}"
                        put(k, new, life)
                elif e.kind == "add":
                    verdict = "duplicate_key"
                elif e.kind in ("set", "set_unique", "update", "only", "only_unique") and here:
                    if taken(merged, k):
                        verdict = "halt_unique"
                    else:
                        put(k, merged, life)
                elif e.kind == "delete":
                    drop(k)
                elif e.kind == "move":
                    if not here:
                        verdict = "noop"
                    elif e.k2 in rows:
                        verdict = "halt_key"
                    elif taken(merged, k):
                        verdict = "halt_unique"
                    else:
                        drop(k)
                        put(e.k2, merged, life)
                out.append((e.pid, verdict, k, created, life))
            yield pd.DataFrame(out, columns=["pid", "verdict", "k", "created", "life"])
        if group:
            yield pd.DataFrame([together()], columns=["pid", "verdict", "k", "created", "life"])

    return run


def named_key(contract: TableContract) -> Column:
    """The whole key that a packet names: in its data (add, set), or in its restriction."""
    data_key = F.when(F.greatest(*[F.col(dp(k)) for k in contract.primary_key], F.lit(False)) & ~F.greatest(*[F.col(dv(k)).isNull() for k in contract.primary_key], F.lit(False)), _json_key([F.col(dv(k)) for k in contract.primary_key]))
    return F.when(F.col("action").isin("add", "set"), data_key).otherwise(_json_key([F.col(rv(k)) for k in contract.primary_key]))


def new_key(contract: TableContract) -> Column:
    """The key of a row after a key move; null where neither data nor restriction names a column."""
    return _json_key([F.when(F.col(dp(k)), F.col(dv(k))).otherwise(F.col(rv(k))) for k in contract.primary_key])


def _written(packets: DataFrame, contract: TableContract, kind: Column, k: Column, k2: Column, life: Column, node: list[Column], last: list[Column]) -> DataFrame:
    ucols = unique_columns(contract)
    given = {c: F.when(F.col(dp(c)), F.col(dv(c)).cast("string")) for c in ucols}
    filled = {c: F.when(F.col(dp(c)), F.col(dv(c))).otherwise(contract.default(c)).cast("string") for c in ucols}
    creates = kind.isin("add", "set", "set_unique")
    known = {c: F.col(dp(c)) | creates for c in ucols}
    lists = {"has": F.array(*[F.col(dp(c)) for c in ucols]).cast("array<boolean>"), "vals": F.array(*given.values()).cast("array<string>"), "new_vals": F.array(*filled.values()).cast("array<string>")}
    cols = {"seq": F.col("seq"), "pid": F.col("__pid"), "kind": kind, "k": k, "k2": k2, "life": life, **lists, "nodes": _nodes(node, contract, filled, known, last)}
    return packets.select(*[cols[c].alias(c) for c in _EVENT_COLUMNS])


def decide(base: DataFrame, packets: DataFrame, contract: TableContract, broadcast_bytes: int, hits: DataFrame | None = None, open_moves: bool = False, by_key: bool = False) -> DataFrame:
    """``__pid, verdict, k, created, life`` for classified full-key, keyless and unique-key packets and moves.

    ``packets``: prepared columns, ``cls``, ``__pid`` (unique text), ``kind`` (add, set, update, only, delete, move, look,
    set_unique, only_unique, probe_unique, none; ``only`` can't insert, ``look`` and ``probe`` change nothing) and, for the ``_unique``
    ones, ``uk_idx``. ``hits``: prepared columns, ``cls``, ``__pid``, ``__life`` and ``__moves`` per row that a packet with
    any number of rows hits; its verdict is go, halt_key or halt_unique. ``open_moves``: some moves name a part of the new key
    only. ``by_key``: no unique keys, ``hits`` or keyless packets; only packets that name a key from or to which a packet moves are
    decided, the others don't depend on any other key. ``k``: the key hit or created, as a JSON array, or ``new:<pid>``.
    """
    key, ucols = list(contract.primary_key), unique_columns(contract)
    kind = F.col("kind")
    named = F.when(kind.isin("add", "set", "update", "only", "delete", "move", "look"), named_key(contract))
    packets = packets.withColumns({"__ek": named, "__ek2": F.when(kind == "move", new_key(contract))})
    if by_key:  # all that is told of a packet, written once: the kind and the keys are long expressions, and are used several times below
        packets = materialize(packets.select("seq", "__pid", "kind", "uk_idx", "__ek", "__ek2"))
    k, k2 = F.col("__ek"), F.col("__ek2")
    made = F.concat(F.lit("n:"), F.col("__pid"))
    node = [k, k2, F.when(kind.isin("add", "set", "set_unique"), made)]
    end = key[-1]
    last = [F.when(F.col(dp(end)), F.col(dv(end))), F.when(F.col(rp(end)), F.col(rv(end)))] if open_moves else []
    no = F.lit(None).cast("string")
    log = _written(packets.where(kind != "none"), contract, kind, k, F.when(kind.endswith("_unique"), F.col("uk_idx").cast("string")).otherwise(k2), no, node, last)
    if by_key:
        ends = packets.where(kind == "move").select(F.explode(F.array(k, k2)).alias("k")).distinct()
        log = log.join(broadcast_if_small(ends, broadcast_bytes) if broadcast_bytes > 0 else ends, "k", "left_semi").select(*_EVENT_COLUMNS)
    if hits is not None:
        writes = F.greatest(*[F.col(dp(c)) for c in ucols], F.col("__moves"), F.lit(False))
        tells = hits.where((F.col("cls") == "del") | F.col("cls").isin("upd", "upd_only") & writes)
        hit_kind = F.when(F.col("cls") == "del", "hit_delete").otherwise("hit_update")
        moved = F.when(F.col("__moves"), new_key(contract))
        packet = F.when(F.col("cls") != "del", F.concat(F.lit("p:"), F.col("__pid")))  # rows deleted by one packet don't depend on one another
        log = log.unionByName(_written(tells, contract, hit_kind, no, moved, F.col("__life"), [F.col("__life"), packet, *([] if open_moves else [moved])], last))
    log = materialize(log)
    named = log.select(F.explode("nodes").alias("n")).distinct()
    named = broadcast_if_small(named, broadcast_bytes) if broadcast_bytes > 0 else named
    row_key = life_of_base(contract)
    row_vals = F.array(*[F.col(c).cast("string") for c in ucols]).cast("array<string>")
    nodes = _nodes([row_key], contract, {c: F.col(c) for c in ucols}, {c: F.lit(True) for c in ucols}, [F.col(end)] if open_moves else [])
    rows = base.select(row_key.alias("k"), row_vals.alias("new_vals"), nodes.alias("nodes"))
    hit = rows.withColumn("n", F.explode("nodes")).join(named, "n", "left_semi").groupBy("k").agg(F.first("new_vals").alias("new_vals"), F.first("nodes").alias("nodes"))
    start = hit.select(
        F.lit(-(1 << 63)).cast("long").alias("seq"), F.lit("").alias("pid"), F.lit("base").alias("kind"), "k", no.alias("k2"), F.col("k").alias("life"),
        F.transform("new_vals", lambda v: F.lit(True)).alias("has"), F.col("new_vals").alias("vals"), "new_vals", "nodes",
    )
    events = materialize(log.unionByName(start))
    links = events.select(F.col("nodes")[0].alias("u"), F.explode("nodes").alias("v"))
    labels = components(links)
    comp = F.coalesce("label", F.col("nodes")[0], F.xxhash64("pid"))
    placed = events.withColumn("n", F.get("nodes", F.lit(0))).join(labels, F.col("n") == F.col("node"), "left").withColumn("comp", comp)
    told = [c for c in _EVENT_COLUMNS[:-1] if ucols or c not in ("has", "vals", "new_vals")]
    ordered = placed.select("comp", *told).repartition("comp").sortWithinPartitions("comp", "seq", "pid")
    places = [[ucols.index(c) for c in uk] for uk in contract.unique_keys]
    found = ordered.mapInPandas(_replay_map(places), "pid string, verdict string, k string, created boolean, life string")
    if hits is not None or by_key:  # the rows that a packet deletes may lie in several components; moves may share a seq
        found = found.groupBy("pid").agg(F.max_by(F.struct("verdict", "k", "created", "life"), F.col("verdict") != "go").alias("r")).select("pid", "r.*")
    return materialize(found.withColumnRenamed("pid", "__pid"))


def with_new_ids(decided: DataFrame, packets: DataFrame, base: DataFrame, contract: TableContract, span: int, broadcast_bytes: int) -> DataFrame:
    """``decided`` with every ``new:`` key replaced by its allocated surrogate id, in order of seq over all new rows."""
    new = decided.where("created").join(packets.select("__pid", "seq"), "__pid").select("seq", "k")
    ids = allocate_keys(new, base, contract.surrogate, span, broadcast_bytes).select(F.col("k").alias("__new"), F.to_json(F.array(F.col(contract.surrogate).cast("string"))).alias("__id"))
    joined = decided.join(materialize(ids), F.col("k") == F.col("__new"), "left")
    return joined.withColumn("k", F.coalesce("__id", "k")).drop("__new", "__id")

"""Two tables in one ordered log: children refer to parents, as of every packet.

A child row may be written only with a parent that is live then; a parent may be deleted only without live children (RESTRICT);
a parent's new key is written to its children (CASCADE). Each table's answers depend on the other one's rows at earlier
packets only, so both are applied in rounds until the answers stay: apply the parents with the deletes known to be refused,
apply the children with the writes known to lack a parent and with one restriction on the foreign key per parent that
moved, then match children's writes with the parents' versions, and parents' deletes with the children's, by intervals of seq.
The answers that stay are the same whatever the first ones were; the first ones are what the packets say by themselves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import ForeignKey, TableContract
from rowtide.functions.packets import dp, dv, map_of
from rowtide.operators.apply import ChangeResult
from rowtide.operators.fold import MIN_SEQ
from rowtide.operators.segmented import apply_log
from rowtide.operators.versions import same_rows, version_intervals
from rowtide.session import DEFAULT_BROADCAST_BYTES, materialize

ENVELOPE = ("seq", "action", "data", "restriction")


@dataclass
class RelatedResult:
    parent: ChangeResult
    child: ChangeResult  # outcomes of the child packets; cascades aren't packets of the log


def _versions(res: ChangeResult, cols: list[str], names: list[str], **options) -> DataFrame:
    """Row identity, ``names``, ``lo``, ``hi``: the values of ``cols`` that the live rows of a result hold, and for which seqs."""
    rows, folded, contract = res.history
    found = version_intervals(rows, folded, contract, cols, **options)
    return found.select(*[F.col(k).alias(f"__id_{k}") for k in contract.primary_key], *[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)], "lo", "hi")


def _rows_at(effects: DataFrame, versions: DataFrame, res: ChangeResult, names: list[str], *more: Column) -> DataFrame:
    """``seq``, ``names`` as of the effect, ``more``."""
    key = res.history[2].primary_key
    slim = effects.select("seq", *[F.col(k).alias(f"__id_{k}") for k in key], *more)
    met = slim.join(versions, [f"__id_{k}" for k in key]).where((F.col("seq") > F.col("lo")) & (F.col("seq") <= F.col("hi")))
    return met.drop("lo", "hi", *[f"__id_{k}" for k in key])


def _moves(res: ChangeResult, versions: DataFrame, fk: ForeignKey, names: list[str]) -> DataFrame:
    """One update per parent that moved: children with the old key get the new one."""
    cols, folded = list(fk.parent_columns), res.history[1]
    if not set(cols) <= set(res.history[2].non_key):  # folded by key: no key moved
        null = F.lit(None).cast("map<string,string>")
        return folded.limit(0).select("seq", "action", null.alias("data"), null.alias("restriction"))
    moved = folded.where((F.col("outcome") == "updated") & (F.col("action") == "update") & F.greatest(*[F.col(dp(c)) for c in cols], F.lit(False)))
    given = [F.col(x(c)) for c in cols for x in (dp, dv)]
    at = _rows_at(moved, versions, res, names, *given)
    new = {n: F.when(F.col(dp(c)), F.col(dv(c))).otherwise(F.col(n)) for c, n in zip(cols, names, strict=True)}
    changed = reduce(lambda a, b: a | b, [~new[n].eqNullSafe(F.col(n)) for n in names])
    data, old = map_of({f: new[n] for f, n in zip(fk.columns, names, strict=True)}), map_of({f: F.col(n) for f, n in zip(fk.columns, names, strict=True)})
    return at.where(changed).select("seq", F.lit("update").alias("action"), data.alias("data"), old.alias("restriction"))


def _covered(asked: DataFrame, held: DataFrame, names: list[str]) -> DataFrame:
    """The distinct seqs of ``asked(seq, names)`` at which some row of ``held`` has these values."""
    points = asked.groupBy(*names, F.expr("seq div 65536").alias("__part")).agg(F.collect_set("seq").alias("__seqs")).drop("__part")
    met = held.join(points, names)
    return met.select(F.explode(F.filter("__seqs", lambda s: (s > F.col("lo")) & (s <= F.col("hi")))).alias("seq")).distinct()


def _first_guess(parent_base: DataFrame, child_base: DataFrame, parent_log: DataFrame, child_log: DataFrame, parent: TableContract, fk: ForeignKey, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Seqs of the deletes that are refused and of the writes without a parent, as far as whole keys in the packets tell.

    A delete is taken as refused if a child refers to the key before it; a parent as live from its first row or write until the
    first delete that isn't refused. Moves and restrictions on other columns are left to the rounds.
    """
    start, seq = F.lit(MIN_SEQ).cast("long").alias("seq"), F.col("seq").cast("long")

    def named(log: DataFrame, packet_map: str, cols: tuple[str, ...], actions: tuple[str, ...]) -> DataFrame:
        typed = [F.col(packet_map).getItem(c).try_cast(parent.type_of(p)).alias(n) for c, p, n in zip(cols, fk.parent_columns, names, strict=True)]
        given = log.where(F.col("action").isin(*actions) & F.col("seq").isNotNull()).select(seq.alias("seq"), *typed)
        return given.dropna(subset=names)

    def held(base: DataFrame, cols: tuple[str, ...]) -> DataFrame:
        return base.select(start, *[F.col(c).cast(parent.type_of(p)).alias(n) for c, p, n in zip(cols, fk.parent_columns, names, strict=True)])

    writes = named(child_log, "data", fk.columns, ("add", "set", "update"))
    refers = held(child_base, fk.columns).unionByName(writes).groupBy(*names).agg(F.min("seq").alias("__ref"))
    deletes = named(parent_log, "restriction", fk.parent_columns, ("delete",)).join(refers, names, "left")
    deletes = materialize(deletes.withColumn("__refused", F.coalesce(F.col("__ref") < F.col("seq"), F.lit(False))))
    made = held(parent_base, fk.parent_columns).unionByName(named(parent_log, "data", fk.parent_columns, ("add", "set", "update")))
    made = made.groupBy(*names).agg(F.min("seq").alias("__made"), F.max("seq").alias("__remade"))
    gone = deletes.where(~F.col("__refused")).groupBy(*names).agg(F.min("seq").alias("__gone"))
    met = writes.join(made, names, "left").join(gone, names, "left")
    missing = F.col("__made").isNull() | (F.col("__made") >= F.col("seq")) | (F.col("__gone") < F.col("seq")) & (F.col("__remade") < F.col("__gone"))
    return materialize(deletes.where("__refused").select("seq").distinct()), materialize(met.where(F.coalesce(missing, F.lit(False))).select("seq").distinct())


def apply_related(
    parent_base: DataFrame, child_base: DataFrame, parent_log: DataFrame, child_log: DataFrame, parent: TableContract, child: TableContract,
    fk: ForeignKey, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, **kw,
) -> RelatedResult:
    """Apply both logs (their seqs are one order, without ties). ``fk.parent_columns`` is the parent's primary key.

    Writes of a child without a live parent are rejected (insert) or halt (reason ``foreign_key``); refused deletes of
    parents halt (reason ``restrict``). NULL refers to nothing.
    """
    options = {"broadcast_bytes": broadcast_bytes}
    names = [f"__f{i}" for i in range(len(fk.columns))]
    cols = list(fk.parent_columns)
    refers = reduce(lambda a, b: a & b, [F.col(dv(c)).isNotNull() for c in fk.columns])
    refused, orphans = _first_guess(parent_base, child_base, parent_log, child_log, parent, fk, names)
    while True:
        parents = apply_log(parent_base, parent_log, parent, refused=refused, **options, **kw)
        lived = materialize(_versions(parents, cols, names, **options))
        moves = materialize(_moves(parents, lived, fk, names))
        children = apply_log(child_base, child_log.select(*ENVELOPE).unionByName(moves), child, orphans=orphans, **options, **kw)

        writes = children.prepared.join(moves.select("seq"), "seq", "left_anti")
        writes = writes.where(F.col("action").isin("add", "set", "update") & F.greatest(*[F.col(dp(c)) for c in fk.columns], F.lit(False)) & refers)
        writes = writes.select("seq", *[F.col(dv(c)).alias(n) for c, n in zip(fk.columns, names, strict=True)])
        now_orphans = materialize(writes.select("seq").distinct().join(_covered(writes, lived, names), "seq", "left_anti"))

        deletes = parents.history[1].where((F.col("action") == "delete") & F.col("outcome").isin("deleted", "quarantined"))
        deletes = _rows_at(deletes, lived, parents, names)
        now_refused = materialize(_covered(deletes, _versions(children, list(fk.columns), names, **options), names))
        if same_rows(now_orphans, orphans) and same_rows(now_refused, refused):
            own = ChangeResult(lambda: children.outcomes.join(moves.select("seq"), "seq", "left_anti"), lambda: children.effects, lambda: children.table, children.history, children.prepared)
            return RelatedResult(parents, own)
        orphans, refused = now_orphans, now_refused

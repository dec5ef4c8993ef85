"""The fold by row life: logs that move keys, or mix unique keys with packets that hit any number of rows.

A row's life begins where it is inserted (or with the base table) and ends where it is deleted; a key move changes its key
columns like any other column. The fold runs on lives instead of keys, so values follow the row, and a restriction on part
of the key is a restriction on columns like any other (:mod:`rowtide.operators.versions`).

Which life a full-key packet hits, and whether a packet is refused for a taken key or unique value, is decided in order of
seq (:mod:`rowtide.operators.conflicts`). Both answers depend on earlier packets only, so they are found in rounds: rows
hit -> verdicts -> fold -> versions -> rows hit, until nothing changes.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv, map_of, rp, rv, with_extra
from rowtide.operators.apply import (
    ChangeResult, _effect_columns, _key_from_packet, _packet_maps, _resolve_conflicts, classify, is_move, spread_outcomes, unsaved,
)
from rowtide.operators.conflicts import life_of_base
from rowtide.operators.fold import DEFAULT_SPAN, fold
from rowtide.operators.versions import with_restriction
from rowtide.session import DEFAULT_BROADCAST_BYTES, materialize

LIFE = "__life"


def life_contract(contract: TableContract) -> TableContract:
    """Keyed by life; the key columns become columns."""
    return replace(contract, columns=((LIFE, "string"), *contract.columns), primary_key=(LIFE,), unique_keys=(), surrogate=None, foreign_keys=())


def with_life(base: DataFrame, contract: TableContract) -> DataFrame:
    return base.select(life_of_base(contract).alias(LIFE), *contract.names)


def may_apply(contract: TableContract) -> Column:
    return F.col("reject_reason").isNull() | is_move(contract)


def is_spread(contract: TableContract) -> Column:
    """Packets that hit any number of rows: a part of the key, or other columns."""
    mk = F.col("match_kind")
    return F.coalesce(may_apply(contract) & ((mk == "non_key") | (mk == "pk_partial") & F.col("action").isin("set", "update", "delete")), F.lit(False))


def spread_predicates(prepared: DataFrame, contract: TableContract) -> DataFrame:
    """Spread packets with their restriction columns: a set is restricted by the key columns in its data."""
    is_set = F.col("action") == "set"
    of = {}
    for c in contract.names:
        if c in contract.primary_key:
            of[c] = (F.when(is_set, F.col(dp(c))).otherwise(F.col(rp(c))), F.when(is_set, F.col(dv(c))).otherwise(F.col(rv(c))))
        else:
            of[c] = (~is_set & F.col(rp(c)), F.col(rv(c)))
    return with_restriction(prepared.where(is_spread(contract)), contract, of)


def _maps(contract: TableContract) -> list[Column]:
    """``data`` / ``restriction`` of the packet to forward, from an effect of a full-key packet."""
    a, names = F.col("action"), contract.names
    value, given = {c: F.col(dv(c)) for c in names}, {c: F.col(dp(c)) for c in names}
    for c in contract.non_key:
        if contract.has_computed_default(c):
            value[c] = F.when(F.col(dp(c)), F.col(dv(c))).otherwise(F.col(f"df__{c}"))
            given[c] = F.col(dp(c)) | (F.col("outcome") == "inserted")
    data = F.when(a.isin("add", "set", "update"), map_of(value, given))
    restriction = F.when(a.isin("update", "delete"), map_of({k: F.col(f"__r_{k}") for k in contract.primary_key}))
    return [with_extra(data, "extra_data").alias("data"), with_extra(restriction, "extra_restriction").alias("restriction")]


def apply_lives(
    base: DataFrame, prepared: DataFrame, contract: TableContract, hits: DataFrame, *, carry: list[str], identity: tuple[str, ...] = (),
    span: int = DEFAULT_SPAN, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, open_moves: bool = False, none_spread: bool = False,
) -> tuple[ChangeResult, DataFrame]:
    """One round: the result if spread packets hit ``hits`` (``__life, __p_seq, __p_<identity>``), and the folded effects by life.

    ``none_spread``: the log is known to hold no spread packets.
    """
    key, lives, move = list(contract.primary_key), life_contract(contract), is_move(contract)
    ok, mk, a, spread = may_apply(contract), F.col("match_kind"), F.col("action"), is_spread(contract)
    keyless = ok & ((a == "add") & mk.isin("none", "unique") | (a == "set") & (mk == "none"))
    took = ok & ~spread & ((mk == "pk") | (a == "set") & (mk == "unique"))
    took = took | keyless if contract.surrogate else took
    names = ["seq", *identity]
    pid = F.concat_ws(":", F.col("seq").cast("string"), *[F.col(c).cast("string") for c in identity])
    named = prepared.withColumns({"__pid": pid, "__move": move, "__moves": move & (mk != "pk")})

    hit = classify(named.where(spread), contract, F.lit(False)).join(hits, [F.col(c) == F.col(f"__p_{c}") for c in names]).drop(*[f"__p_{c}" for c in names])
    hit = hit.limit(0) if none_spread else materialize(hit)
    rows = classify(named.where(took), contract, F.lit(True))
    by_key = none_spread and not contract.unique_keys and contract.surrogate is None
    rows, decided = _resolve_conflicts(rows, base, contract, span, broadcast_bytes, None if by_key else hit, True, open_moves, by_key)
    # the packets that are decided one by one restrict nothing but the key, or aren't restricted
    unused = {rp(c): F.lit(False) for c in contract.non_key} | {rv(c): F.lit(None).cast(contract.type_of(c)) for c in contract.non_key}
    rows = materialize(rows.drop(*unused, "unknown_data", "unknown_restriction", "bad_value", "reject_reason", "kind", "uk_idx", "__move", "__moves", "created")).withColumns(unused)
    go = F.col("verdict") == "go"

    # the key columns are written by inserts, and by moves as far as they name them
    makes = a.isin("add", "set")
    own = _key_from_packet(contract)
    plain = rows.where(go).withColumn(LIFE, F.coalesce("life", F.concat(F.lit("x:"), "__pid")))
    plain = plain.withColumns({f"__o_{k}": F.coalesce(F.col(f"__k_{k}"), own[k]).cast(contract.type_of(k)) for k in key} | {f"__r_{k}": F.col(rv(k)) for k in key})
    plain = plain.withColumns({dv(k): F.when(makes, F.col(f"__o_{k}")).otherwise(F.col(dv(k))) for k in key} | {dp(k): makes | F.col(dp(k)) for k in key})
    extra = [*carry, *[f"__o_{k}" for k in key], *[f"__r_{k}" for k in key]]
    effects = plain.select(*_effect_columns(lives, extra, {LIFE: F.col(LIFE)}))
    stopped = decided.where(F.col("verdict").isin("halt_unique", "halt_key")).select(F.col("__pid").alias("__stop"), F.col("verdict").alias("__why"))
    hit = hit.join(stopped, F.col("__pid") == F.col("__stop"), "left")
    halts = F.col("__why").isNotNull()
    hit = hit.withColumns({
        "cls": F.when(halts, "halt").otherwise(F.col("cls")),
        "pre_reason": F.when(F.col("__why") == "halt_unique", "duplicate_unique").when(halts, "duplicate_key").otherwise(F.col("pre_reason")),
        # a partial set that would break a key halts on the rows it hits
        **{f"__o_{k}": F.lit(None).cast(contract.type_of(k)) for k in key}, **{f"__r_{k}": F.col(rv(k)) for k in key},
    })
    effects = effects.unionByName(hit.select(*_effect_columns(lives, extra, {LIFE: F.col(LIFE)})))
    before = with_life(base, contract)
    result = fold(before, effects, lives, span, broadcast_bytes)
    folded = result.effects

    many = F.col("match_kind").isin("pk_partial", "non_key")
    direct = folded.where(~many).select(
        "seq", "action", "match_kind", *[F.col(f"__o_{k}").alias(k) for k in key], "outcome", "reason",
        F.when(F.col("outcome").isin("inserted", "updated", "deleted"), 1).otherwise(0).alias("rows"), *_maps(contract), *carry,
    )
    outcomes = direct.unionByName(spread_outcomes(prepared.where(spread), folded.where(many), contract, identity, carry))
    no_key = keyless if contract.surrogate is None else F.lit(False)
    bad = prepared.where(~ok | no_key | ok & (mk == "pk_partial") & (a == "add"))
    outcomes = outcomes.unionByName(unsaved(
        bad, contract, carry, F.when(ok | (F.col("reject_reason") == "null_key"), "rejected").otherwise("quarantined"),
        F.when(ok, "null_key").otherwise(F.col("reject_reason")),
    ))
    v = F.col("verdict")
    outcome = F.when(v == "noop", "noop").when(v.startswith("halt"), "quarantined").otherwise("rejected")
    reason = F.when(v.isin("duplicate_unique", "halt_unique"), "duplicate_unique").when(v.isin("duplicate_key", "halt_key"), "duplicate_key")
    outcomes = outcomes.unionByName(rows.where(~go).select(
        "seq", "action", "match_kind", *[F.coalesce(F.col(f"__k_{k}"), own[k]).cast(contract.type_of(k)).alias(k) for k in key],
        outcome.alias("outcome"), reason.alias("reason"), F.lit(0).alias("rows"), *_packet_maps(contract, False), *carry,
    ))
    shown = folded.withColumns({k: F.col(f"__o_{k}") for k in key}).drop(LIFE, *[f"__o_{k}" for k in key], *[f"__r_{k}" for k in key])
    return ChangeResult(outcomes, shown, lambda: result.table.select(*contract.names), (before, folded, lives), prepared), folded

"""Projection of packets onto a table contract (align, type, validate, resolve the match kind).

All of it is row-local column arithmetic: no shuffle, stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import ACTIONS, dp, dv, extra_entries, has, raw, rp, rv, typed, unknown_keys

ENVELOPE = ("seq", "action", "data", "restriction")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols, F.lit(True))


def align_columns(packets: DataFrame, contract: TableContract) -> DataFrame:
    """Wide form: per contract column a presence flag and a typed value, for data and restriction.

    Unknown columns are no part of it: their names are listed for validation, their entries are kept as they came, to be
    forwarded. Values are cast with ``try_cast`` so one bad value cannot fail the job.
    """
    extra = [c for c in packets.columns if c not in ENVELOPE]
    cols: list[Column] = [F.col(c) for c in ENVELOPE] + [F.col(c) for c in extra]
    bad_parts = []
    for c in contract.names:
        t = contract.type_of(c)
        cols += [has("data", c).alias(dp(c)), typed("data", c, t).alias(dv(c))]
        cols += [has("restriction", c).alias(rp(c)), typed("restriction", c, t).alias(rv(c))]
        bad_parts.append(raw("data", c).isNotNull() & typed("data", c, t).isNull())
        bad_parts.append(raw("restriction", c).isNotNull() & typed("restriction", c, t).isNull())
    cols += [
        unknown_keys("data", contract).alias("unknown_data"),
        unknown_keys("restriction", contract).alias("unknown_restriction"),
        _any(bad_parts).alias("bad_value"),
        extra_entries("data", contract).alias("extra_data"),
        extra_entries("restriction", contract).alias("extra_restriction"),
    ]
    return packets.select(*cols)


def resolve_key(aligned: DataFrame, contract: TableContract) -> DataFrame:
    """Add ``match_kind``: which columns identify the rows a packet touches.

    add/set look at ``data``: ``pk`` (whole key), ``pk_partial`` (part of a composite key),
    ``unique`` (no key column but a whole unique key, first in contract order), ``none``.
    update/delete look at ``restriction``: ``pk`` (exactly the key), ``pk_partial`` (part of the
    key only), ``non_key`` (some non-key column involved), ``none`` (nothing usable).
    """
    pk = list(contract.primary_key)
    in_data = [F.col(dp(k)) for k in pk]
    data_kind = (
        F.when(_all(in_data), "pk")
        .when(_any(in_data), "pk_partial")
    )
    for uk in contract.unique_keys:
        data_kind = data_kind.when(_all([F.col(dp(c)) for c in uk]), "unique")
    data_kind = data_kind.otherwise("none")
    in_restr = [F.col(rp(k)) for k in pk]
    non_key_restr = _any([F.col(rp(c)) for c in contract.non_key])
    restr_kind = (
        F.when(non_key_restr, "non_key")
        .when(_all(in_restr), "pk")
        .when(_any(in_restr), "pk_partial")
        .otherwise("none")
    )
    kind = F.when(F.col("action").isin("add", "set"), data_kind).when(F.col("action").isin("update", "delete"), restr_kind)
    return aligned.withColumn("match_kind", kind)


def validate_packets(aligned: DataFrame, contract: TableContract, strict_restrictions: bool = True) -> DataFrame:
    """Add ``reject_reason`` for packets that can never apply, whatever the table holds.

    State-dependent rejects (duplicate key, NOT NULL on insert, halts on live rows) are decided by
    the fold. Reasons, first match wins: malformed, unknown_action, missing_seq, bad_value,
    missing_data, empty_restriction, unknown_column (strict mode), null_key, key_move.
    """
    action = F.col("action")
    any_data = _any([F.col(dp(c)) for c in contract.names])
    any_restr = _any([F.col(rp(c)) for c in contract.names])
    null_key = _any([F.col(dp(k)) & F.col(dv(k)).isNull() for k in contract.primary_key])
    key_move = _any(
        [F.col(dp(k)) & ~(F.col(rp(k)) & F.col(dv(k)).eqNullSafe(F.col(rv(k)))) for k in contract.primary_key]
    )
    reason = (
        F.when(action.isNull(), "malformed")
        .when(~action.isin(*ACTIONS), "unknown_action")
        .when(F.col("seq").isNull(), "missing_seq")
        .when(F.col("bad_value"), "bad_value")
        .when(action.isin("add", "set", "update") & ~any_data, "missing_data")
        .when(action.isin("update", "delete") & ~any_restr, "empty_restriction")
    )
    if strict_restrictions:
        reason = reason.when(action.isin("update", "delete") & (F.size("unknown_restriction") > 0), "unknown_column")
    reason = reason.when(action.isin("add", "set") & null_key, "null_key")
    reason = reason.when((action == "update") & key_move, "key_move")
    return aligned.withColumn("reject_reason", reason)


def prepare(packets: DataFrame, contract: TableContract, strict_restrictions: bool = True) -> DataFrame:
    """align -> resolve_key -> validate, the state-free part of packet processing."""
    return validate_packets(resolve_key(align_columns(packets, contract), contract), contract, strict_restrictions)

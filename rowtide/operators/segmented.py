"""Tier dispatch for a whole log: folds, key moves, and restrictions on any columns.

A packet whose restriction names other columns than the key can hit rows whose values were written by earlier packets of
the same log, and may itself write what a later one looks for. All such packets are found together, in rounds: fold the log
with the rows they are known to hit, match their restrictions with the versions of all rows as of each packet
(:mod:`rowtide.operators.versions`), and fold again, until the hits stay as they are. What a packet hits depends on earlier
packets only, so after n rounds all chains of n such packets are right, whatever the first guess was, and rows that stay are
the result of applying the packets one by one. Logs in which they can't touch what others look for settle after one round.
By row life, the first guess is what the restrictions hit in the base table: where the log changes none of these rows before
its packet, the first round only confirms it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, rp, rv
from rowtide.operators.align import prepare
from rowtide.operators.apply import ChangeResult, apply_changes, fk_violations, flag_duplicate_seq, is_move, is_open_move, stop_at_halt
from rowtide.operators.fold import DEFAULT_SPAN
from rowtide.operators.lives import LIFE, apply_lives, is_spread, life_contract, spread_predicates, with_life
from rowtide.operators.versions import base_hits, find_hits, patterns, qp, same_rows, with_restriction
from rowtide.session import DEFAULT_BROADCAST_BYTES, materialize


def _no_hits(prepared: DataFrame, contract: TableContract, names: list[str]) -> DataFrame:
    fields = [T.StructField(k, contract.spark_type(k)) for k in contract.primary_key]
    fields += [T.StructField(f"__p_{n}", prepared.schema[n].dataType) for n in names]
    return prepared.sparkSession.createDataFrame([], T.StructType(fields))


def _rounds(step: Callable[[DataFrame], tuple[ChangeResult, DataFrame]], find: Callable[[DataFrame], DataFrame], hits: DataFrame, once: bool) -> ChangeResult:
    """Fold and match until the hits are those of the round before; ``once``: the first match is known to be final."""
    result, folded = step(hits)
    while True:
        found = find(folded)
        if same_rows(found, hits):
            return result
        hits = found
        result, folded = step(hits)
        if once:
            return result


def apply_log(
    base: DataFrame, packets: DataFrame, contract: TableContract, *, strict_restrictions: bool = True, on_error: str = "quarantine",
    parents: dict[str, DataFrame] | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, identity: tuple[str, ...] = (),
    span: int = DEFAULT_SPAN, orphans: DataFrame | None = None, refused: DataFrame | None = None,
) -> ChangeResult:
    """Apply any log: one outcome per packet, each packet in the tier it needs.

    Logs of whole keys (and of parts of a key, without unique keys) are one :func:`apply_changes`. Logs that move keys, or
    mix unique keys with packets of any number of rows, go by row life; other restrictions by key. ``orphans``: seqs of packets
    that write a foreign key without a parent; ``refused``: seqs of deletes that another table refuses.
    """
    parsed = materialize(prepare(packets, contract, strict_restrictions).drop("data", "restriction"))
    prepared = flag_duplicate_seq(parsed, identity, broadcast_bytes)
    if contract.foreign_keys and parents:
        prepared = fk_violations(prepared, contract, parents, broadcast_bytes)
    for seqs, flag in ((orphans, "fk_bad"), (refused, "refused")):
        if seqs is not None:
            marked = seqs.select(F.col("seq").alias("__seq"), F.lit(True).alias("__flag"))
            flagged = F.coalesce("__flag", F.col(flag) if flag in prepared.columns else F.lit(False))
            prepared = prepared.join(marked, F.col("seq") == F.col("__seq"), "left").withColumn(flag, flagged).drop("__seq", "__flag")
    prepared = prepared if prepared is parsed else materialize(prepared)
    barrier = F.coalesce(F.col("reject_reason").isNull() & (F.col("match_kind") == "non_key"), F.lit(False))
    a, names = F.col("action"), ["seq", *identity]
    seen = prepared.agg(
        F.count_if(barrier).alias("barriers"), F.count_if(is_move(contract)).alias("moves"), F.count_if(is_open_move(contract)).alias("open_moves"), F.count_if(is_spread(contract)).alias("spread"),
        F.count_if(barrier & (a == "delete")).alias("deletes"), F.count_if(~barrier & a.isin("add", "set")).alias("inserts"),
        *[F.count_if(barrier & F.col(dp(c))).alias(f"w_{c}") for c in contract.names],
    ).first()
    options = {"span": span, "broadcast_bytes": broadcast_bytes}
    extras = [c for c in packets.columns if c not in ("seq", "action", "data", "restriction")]

    if seen["moves"] or contract.unique_keys and seen["spread"]:
        lives, predicates = life_contract(contract), spread_predicates(prepared, contract)
        predicates = materialize(predicates.select(*names, *[qp(c) for c in contract.names], *[f"q__{c}" for c in contract.names]))
        sets, rows = patterns(predicates, contract), with_life(base, contract)

        def step(hits: DataFrame) -> tuple[ChangeResult, DataFrame]:
            return apply_lives(base, prepared, contract, hits, carry=extras, identity=identity, open_moves=seen["open_moves"] > 0, none_spread=not seen["spread"], **options)

        def find(folded: DataFrame) -> DataFrame:
            if not sets:
                return _no_hits(prepared, lives, names)
            return find_hits(rows, folded, predicates.withColumns({qp(LIFE): F.lit(False)}), lives, sets, names, **options)

        if sets:
            guess = base_hits(rows, predicates.withColumns({qp(LIFE): F.lit(False)}), lives, sets, names, broadcast_bytes)
        else:
            guess = _no_hits(prepared, lives, names)
        result = _rounds(step, find, guess, False) if seen["spread"] else step(guess)[0]
    elif seen["barriers"]:
        predicates = with_restriction(prepared.where(barrier), contract, {c: (F.col(rp(c)), F.col(rv(c))) for c in contract.names})
        predicates = materialize(predicates.select(*names, *[qp(c) for c in contract.names], *[f"q__{c}" for c in contract.names]))
        sets = patterns(predicates, contract)
        written = any(seen[f"w_{c}"] for s in sets for c in s if c not in contract.primary_key)
        once = not written and not (seen["deletes"] and seen["inserts"])

        def step(hits: DataFrame) -> tuple[ChangeResult, DataFrame]:
            res = apply_changes(base, packets, contract, prepared=prepared, identity=identity, hits=hits, **options)
            return res, res.effects

        def find(folded: DataFrame) -> DataFrame:
            return find_hits(base, folded, predicates, contract, sets, names, **options)

        result = _rounds(step, find, _no_hits(prepared, contract, names), once)
    else:
        result = apply_changes(base, packets, contract, prepared=prepared, identity=identity, **options)
    if on_error == "fail":
        stop_at_halt(result.outcomes)
    return result


def apply_segmented(base: DataFrame, packets: DataFrame, contract: TableContract, **kw) -> ChangeResult:
    """Apply a log that contains restrictions on non-key columns: see :func:`apply_log`."""
    return apply_log(base, packets, contract, **kw)


def apply_key_moves(base: DataFrame, packets: DataFrame, contract: TableContract, **kw) -> ChangeResult:
    """Apply a log with key-moving updates (whole or partial images): see :mod:`rowtide.operators.lives`.

    A move happens if the old row is live (else it hits nothing) and the new key is free (else it halts), both as of
    its seq; columns that the packet doesn't name move with the row.
    """
    return apply_log(base, packets, contract, **kw)

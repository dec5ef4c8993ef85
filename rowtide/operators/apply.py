"""Change application: packets -> per-packet outcomes + new table snapshot.

Tiers (chosen per packet by ``match_kind``):

* T1  whole primary key given: straight into the fold.
* keyless add/set with a surrogate key: ids allocated in seq order, data enriched, then T1.
* tables with unique keys, and logs with key-moving updates: owners of unique values and keys are decided in
  order of seq first (:mod:`rowtide.operators.conflicts`); packets then go on with the key they hit or create.
* T2  part of a composite key: looked up per row in linear space (:mod:`rowtide.operators.prefixes`); mixed with T3 or unique
  keys, expanded by a join with the key universe (base keys + keys the log inserts).
* T3  restriction on non-key columns: the rows hit come from the rows' versions (:mod:`rowtide.operators.versions`) and
  are effects like those of T2.
* Logs that move keys, or mix unique keys with T2 or T3, are folded by row life (:mod:`rowtide.operators.lives`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv, map_of, rp, rv, with_extra
from rowtide.operators.align import _all, _any, prepare
from rowtide.operators.conflicts import decide, named_key, with_new_ids
from rowtide.operators.fold import DEFAULT_SPAN, effect_counts, fold
from rowtide.operators.keys import allocate_keys
from rowtide.operators.prefixes import Prefixes, fold_with_prefixes
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small, materialize, measured_bytes

OUTCOMES = ("inserted", "updated", "deleted", "noop", "rejected", "quarantined")
# Reasons that only ever reject an insert (an integrity error in the reference): rejected, counted.
INTEGRITY_REASONS = ("null_key", "not_null", "duplicate_key", "foreign_key", "partial_key")


class PacketHalt(RuntimeError):
    """A packet that stops the batch under ``on_error='fail'``."""


Part = DataFrame | Callable[[], DataFrame]


class ChangeResult:
    """What a log does. A part that is given as a function is made when it is first read, like any DataFrame that nobody reads."""

    def __init__(self, outcomes: Part, effects: Part, table: Part, history: tuple[DataFrame, Part, TableContract] | None = None, prepared: DataFrame | None = None):
        self._outcomes, self._effects, self._table, self._history = outcomes, effects, table, history
        self.prepared = prepared  # the aligned log

    @cached_property
    def outcomes(self) -> DataFrame:
        """One row per packet."""
        return _made(self._outcomes)

    @cached_property
    def effects(self) -> DataFrame:
        """One row per (packet, table row) reaching the fold."""
        return _made(self._effects)

    @cached_property
    def table(self) -> DataFrame:
        """The new snapshot."""
        return _made(self._table)

    @cached_property
    def history(self) -> tuple[DataFrame, DataFrame, TableContract] | None:
        """Rows before, folded effects and their contract (by key or by life)."""
        return self._history and (self._history[0], _made(self._history[1]), self._history[2])


def _made(part: Part) -> DataFrame:
    return part() if callable(part) else part


def fk_violations(prepared: DataFrame, contract: TableContract, parents: dict[str, DataFrame] | None,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Add ``fk_bad``: the packet writes a foreign key value that has no parent row.

    Parents are static within a batch. The parent key set is broadcast only if its measured size
    allows; otherwise a shuffle join.
    """
    out = prepared.withColumn("fk_bad", F.lit(False))
    for fk in contract.foreign_keys:
        if not parents or fk.name not in parents:
            continue
        pk = parents[fk.name].select(*[F.col(p).alias(f"__fk_{c}") for c, p in zip(fk.columns, fk.parent_columns)])
        written = prepared.select(*[F.col(dv(c)).alias(f"__fk_{c}") for c in fk.columns]).distinct()
        pk = pk.join(written, [f"__fk_{c}" for c in fk.columns], "left_semi").distinct()
        pk = broadcast_if_small(pk.withColumn("__parent", F.lit(True)), broadcast_bytes) if broadcast_bytes > 0 else pk.withColumn("__parent", F.lit(True))
        writes = _all([F.col(dp(c)) & F.col(dv(c)).isNotNull() for c in fk.columns])
        cond = [F.col(dv(c)) == F.col(f"__fk_{c}") for c in fk.columns]
        out = out.join(pk, cond, "left").withColumn(
            "fk_bad", F.col("fk_bad") | (writes & F.col("__parent").isNull())
        ).drop("__parent", *[f"__fk_{c}" for c in fk.columns])
    return out


def classify(df: DataFrame, contract: TableContract, key_ok: Column) -> DataFrame:
    """Fold class ``cls`` and ``pre_reason`` from the packet alone (see ``fold.FOLD_CLASSES``)."""
    nn = [c for c in contract.non_key if c in contract.required]
    nn_null = _any([F.col(dp(c)) & F.col(dv(c)).isNull() for c in nn])
    nn_missing = _any([~F.col(dp(c)) for c in nn if c not in contract.defaults])
    fk_bad = F.col("fk_bad") if "fk_bad" in df.columns else F.lit(False)
    refused = F.col("refused") if "refused" in df.columns else F.lit(False)
    a = F.col("action")
    cls = (
        F.when((a == "add") & key_ok & ~nn_null & ~fk_bad & ~nn_missing, "ins")
        .when(a == "add", "add_bad")
        .when((a == "set") & (nn_null | fk_bad), "halt")
        .when((a == "set") & (~key_ok | nn_missing), "upd_only")
        .when(a == "set", "ins")
        .when((a == "update") & (nn_null | fk_bad), "halt")
        .when(a == "update", "upd")
        .when(refused, "halt")
        .otherwise("del")
    )
    pre = (
        F.when(refused, "restrict")
        .when((a == "add") & ~key_ok, "null_key")
        .when(fk_bad, "foreign_key")
        .when(nn_null | nn_missing, "not_null")
        .when((a == "set") & ~key_ok, "partial_key")
    )
    return df.withColumn("cls", cls).withColumn("pre_reason", pre)


def _effect_columns(contract: TableContract, carry: list[str], key_from: dict[str, Column]) -> list[Column]:
    cols = [F.col("seq"), F.col("action"), F.col("match_kind"), F.col("cls"), F.col("pre_reason")]
    cols += [key_from[k].cast(contract.type_of(k)).alias(k) for k in contract.primary_key]
    for c in contract.non_key:
        cols += [F.col(dp(c)), F.col(dv(c))]
        if contract.has_computed_default(c):
            cols.append(contract.default(c).alias(f"df__{c}"))
    cols += [F.col(c) for c in ("extra_data", "extra_restriction", *carry)]
    return cols


def _key_from_packet(contract: TableContract) -> dict[str, Column]:
    return {k: F.when(F.col("action").isin("add", "set"), F.col(dv(k))).otherwise(F.col(rv(k))) for k in contract.primary_key}


def _with_assigned_key(df: DataFrame, contract: TableContract, assigned: list[str]) -> DataFrame:
    """Write engine-assigned key columns into the typed data columns.

    The forwarded packet is rebuilt from the typed columns, so it carries the assigned key (K4).
    """
    for k in assigned:
        df = df.withColumn(dp(k), F.lit(True)).withColumn(dv(k), F.col(f"__k_{k}").cast(contract.type_of(k)))
    return df.drop(*[f"__k_{k}" for k in assigned])


def _packet_maps(contract: TableContract, key_cols: bool) -> list[Column]:
    """``data`` / ``restriction`` maps of the packet to forward, rebuilt from the typed columns.

    Columns unknown here are forwarded as they came (a receiver's table may have them), and so is an engine-assigned key.
    ``key_cols``: the rows carry the resolved key in plain key columns (fold effects) instead of
    the restriction columns.
    """
    a = F.col("action")
    if key_cols:
        data_vals = {c: F.col(c) if c in contract.primary_key else F.col(dv(c)) for c in contract.names}
        data_has = {c: F.lit(True) if c in contract.primary_key else F.col(dp(c)) for c in contract.names}
        for c in contract.non_key:  # a default taken from the packet (now()) is forwarded, so that replicas agree
            if contract.has_computed_default(c):
                data_vals[c] = F.when(F.col(dp(c)), F.col(dv(c))).otherwise(F.col(f"df__{c}"))
                data_has[c] = F.col(dp(c)) | (F.col("outcome") == "inserted")
        restr = map_of({k: F.col(k) for k in contract.primary_key})
    else:
        data_vals = {c: F.col(dv(c)) for c in contract.names}
        data_has = {c: F.col(dp(c)) for c in contract.names}
        restr = map_of({c: F.col(rv(c)) for c in contract.names}, {c: F.col(rp(c)) for c in contract.names})
    upd_has = {c: (F.lit(False) if c in contract.primary_key else h) for c, h in data_has.items()} if key_cols else data_has
    data = F.when(a.isin("add", "set"), map_of(data_vals, data_has)).when(a == "update", map_of(data_vals, upd_has))
    return [with_extra(data, "extra_data").alias("data"), F.when(a.isin("update", "delete"), with_extra(restr, "extra_restriction")).alias("restriction")]


def flag_duplicate_seq(prepared: DataFrame, identity: tuple[str, ...] = (), broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``reject_reason = 'duplicate_seq'`` for packets that share a seq: they have no order, so none of them can apply.

    ``identity``: columns that name a packet together with seq (the target of a forwarded packet).
    """
    by = ["seq", *identity]
    twice = prepared.where(F.col("seq").isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    if twice.isEmpty():
        return prepared
    twice = twice.select(*[F.col(c).alias(f"__d_{c}") for c in by], F.lit(True).alias("__twice"))
    twice = broadcast_if_small(twice, broadcast_bytes) if broadcast_bytes > 0 else twice
    out = prepared.join(twice, [F.col(c).eqNullSafe(F.col(f"__d_{c}")) for c in by], "left")
    reason = F.coalesce("reject_reason", F.when(F.col("__twice"), "duplicate_seq"))
    return out.withColumn("reject_reason", reason).drop("__twice", *[f"__d_{c}" for c in by])


def is_move(contract: TableContract) -> Column:
    """An update that can move keys: it writes key columns, and no NULL into them."""
    null = _any([F.col(dp(k)) & F.col(dv(k)).isNull() for k in contract.primary_key])
    return F.coalesce((F.col("reject_reason") == "key_move") & F.col("match_kind").isin("pk", "pk_partial", "non_key") & ~null, F.lit(False))


def is_open_move(contract: TableContract) -> Column:
    """A move whose new key depends on the row: data and restriction don't name all of it."""
    named = _all([F.col(dp(k)) | F.col(rp(k)) for k in contract.primary_key])
    return is_move(contract) & ~named


def _resolve_conflicts(rows: DataFrame, base: DataFrame, contract: TableContract, span: int, broadcast_bytes: int,
                       hits: DataFrame | None = None, by_life: bool = False, open_moves: bool = False, by_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """Classified packets with ``verdict``, ``life`` and the key columns ``__k_<key>`` they hit or create; all verdicts.

    ``by_life``: rows carry ``__move``, and packets that would halt look up the life they hit. ``by_key``: nothing but moves of
    whole keys ties keys together, so packets that name a key no move names aren't replayed: their life is that key.
    """
    a, cls, mk = F.col("action"), F.col("cls"), F.col("match_kind")
    by_unique = (mk == "unique") & (a == "set")
    kind = (
        F.when(F.col("__move") & (cls == "upd") if by_life else F.lit(False), "move")
        .when((cls == "halt") & ~by_unique if by_life else F.lit(False), "look")
        .when(by_unique, F.when(cls == "ins", "set_unique").when(cls == "upd_only", "only_unique").otherwise("probe_unique"))
        .when(cls == "ins", a)
        .when(cls == "upd_only", "only")
        .when(cls == "upd", "update")
        .when(cls == "del", "delete")
        .otherwise("none")
    )
    uk_idx = F.lit(None).cast("int")
    for i in reversed(range(len(contract.unique_keys))):
        uk_idx = F.when(_all([F.col(dp(c)) for c in contract.unique_keys[i]]), F.lit(i)).otherwise(uk_idx)
    # kind none: a packet that can't change anything; the fold refuses it on its own key
    rows = rows.withColumn("kind", kind).withColumn("uk_idx", uk_idx)
    if not by_life:  # by life, rows are columns of an aligned log that is written already
        rows = materialize(rows)
    decided = decide(base, rows, contract, broadcast_bytes, hits, open_moves, by_key)
    if contract.surrogate is not None:
        decided = materialize(with_new_ids(decided, rows, base, contract, span, broadcast_bytes))
    joined = rows.join(decided.withColumn("__replayed", F.lit(True)), "__pid", "left").withColumn("verdict", F.coalesce("verdict", F.lit("go")))
    own = _key_from_packet(contract)
    if by_key:  # no packet hits or creates another key than the one it names
        alone = F.when(F.col("__replayed").isNull() & (F.col("kind") != "none"), named_key(contract))
        joined = joined.withColumn("life", F.coalesce("life", alone)).withColumns({f"__k_{k}": own[k].cast(contract.type_of(k)) for k in contract.primary_key})
        return joined.drop("__replayed"), decided
    joined = joined.drop("__replayed")
    parts = F.from_json("k", "array<string>")
    for i, k in enumerate(contract.primary_key):
        given = F.when(F.col("kind") == "none", own[k])
        joined = joined.withColumn(f"__k_{k}", F.coalesce(parts[i].cast(contract.type_of(k)), given))
    return joined, decided


def expand_partial(partial: DataFrame, universe: DataFrame, contract: TableContract, broadcast_bytes: int) -> DataFrame:
    """Join packets that give part of a composite key with the key universe on the given columns."""
    key = list(contract.primary_key)
    a = F.col("action")
    present = {k: F.when(a == "set", F.col(dp(k))).otherwise(F.col(rp(k))) for k in key}
    value = {k: F.when(a == "set", F.col(dv(k))).otherwise(F.col(rv(k))) for k in key}
    uni = universe.select(*[F.col(k).alias(f"__k_{k}") for k in key])
    # one materialisation and one size check for all partial packets, then a join per key pattern
    small = False
    if broadcast_bytes > 0:
        partial = materialize(partial)
        small = measured_bytes(partial) <= broadcast_bytes
    parts = []
    for n in range(1, len(key)):
        for given in combinations(key, n):
            sel = partial.where(_all([present[k] for k in given]) & ~_any([present[k] for k in key if k not in given]))
            sel = F.broadcast(sel) if small else sel
            parts.append(sel.join(uni, [value[k] == F.col(f"__k_{k}") for k in given], "inner"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def spread_outcomes(packets: DataFrame, folded: DataFrame, contract: TableContract, identity: tuple[str, ...], carry: list[str]) -> DataFrame:
    """One outcome per packet that may hit any number of rows, from its effects."""
    o = F.col("outcome")
    pri = F.when(o == "quarantined", 4).when(o.isin("updated", "deleted"), 3).when(o == "rejected", 2).otherwise(1)
    agg = folded.groupBy("seq", *identity).agg(
        F.max_by(F.struct("outcome", "reason"), pri).alias("o"), F.sum(F.when(o.isin("updated", "deleted"), 1).otherwise(0)).alias("rows"),
    )
    packets = packets.select("seq", "action", "match_kind", *_packet_maps(contract, False), *carry)
    return packets.join(agg, ["seq", *identity], "left").select(
        "seq", "action", "match_kind", *[F.lit(None).cast(contract.type_of(k)).alias(k) for k in contract.primary_key],
        F.coalesce(F.col("o.outcome"), F.when(F.col("action") == "set", "rejected").otherwise("noop")).alias("outcome"),
        F.when(F.col("o").isNotNull(), F.col("o.reason")).when(F.col("action") == "set", "partial_key").alias("reason"),
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"), "data", "restriction", *carry,
    )


def unsaved(packets: DataFrame, contract: TableContract, carry: list[str], outcome: Column, reason: Column) -> DataFrame:
    """Outcomes of packets that no state can save."""
    return packets.select(
        "seq", "action", "match_kind", *[F.lit(None).cast(contract.type_of(k)).alias(k) for k in contract.primary_key],
        outcome.alias("outcome"), reason.alias("reason"), F.lit(0).alias("rows"), *_packet_maps(contract, False), *carry,
    )


def stop_at_halt(outcomes: DataFrame) -> None:
    """The reference's worker stops at a halting packet: the whole batch fails, nothing is applied."""
    first = outcomes.where(F.col("outcome") == "quarantined").select("seq", "reason").orderBy("seq").limit(1).collect()
    if first:
        raise PacketHalt(f"packet {first[0]['seq']} halts the batch: {first[0]['reason']}")


def apply_changes(
    base: DataFrame,
    packets: DataFrame,
    contract: TableContract,
    *,
    parents: dict[str, DataFrame] | None = None,
    strict_restrictions: bool = True,
    on_error: str = "quarantine",
    span: int = DEFAULT_SPAN,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    prepared: DataFrame | None = None,
    identity: tuple[str, ...] = (),
    hits: DataFrame | None = None,
) -> ChangeResult:
    """Apply an ordered packet log (``seq, action, data, restriction`` + extra columns) to ``base``.

    ``on_error='fail'`` raises :class:`PacketHalt` (one small top-1 job) if any packet would halt,
    like the reference's halting worker; ``'quarantine'`` sets it aside and goes on.
    Packets with non-key restrictions and key moves need :func:`rowtide.operators.segmented.apply_log`, which chooses the
    tier. ``hits``: the rows that non-key restrictions hit (key columns, ``__p_seq`` and ``__p_<identity>``); without it such
    packets are quarantined with reason ``needs_barrier``. ``identity``: columns that name a packet together with seq.
    """
    key = list(contract.primary_key)
    if prepared is None:
        # Parsed once and written once (a table in the shared checkpoint folder), then read by every
        # tier branch below. A lazily filled cache would be computed again by each concurrently
        # started stage, and routing predicates would be pushed into the parsing and repeat it.
        # The raw maps are not needed past alignment (forwarded packets are rebuilt from typed columns).
        parsed = materialize(prepare(packets, contract, strict_restrictions).drop("data", "restriction"))
        prepared = flag_duplicate_seq(parsed, identity, broadcast_bytes)
        if contract.foreign_keys and parents:
            prepared = fk_violations(prepared, contract, parents, broadcast_bytes)
        prepared = prepared if prepared is parsed else materialize(prepared)
    else:
        # a caller-held prepared log (e.g. one segment of a cached log in apply_segmented)
        prepared = prepared.drop("data", "restriction")
    extras = [c for c in packets.columns if c not in ("seq", "action", "data", "restriction")]
    carry = extras
    conflicts = bool(contract.unique_keys)
    ok = F.col("reject_reason").isNull()
    mk, a = F.col("match_kind"), F.col("action")
    full = ok & (mk == "pk")
    keyless = ok & a.isin("add", "set") & (mk.isin("none", "unique") & (a == "add") | (mk == "none") & (a == "set"))
    by_unique = ok & (a == "set") & (mk == "unique")
    partial = ok & (mk == "pk_partial") & a.isin("set", "update", "delete")
    partial_add = ok & (mk == "pk_partial") & (a == "add")

    refused = None
    no_key = F.lit(False)
    own_key = _key_from_packet(contract)
    if conflicts:
        took = full | by_unique | (keyless if contract.surrogate else F.lit(False))
        pid = F.concat_ws(":", F.col("seq").cast("string"), *[F.col(c).cast("string") for c in identity])
        rows = classify(prepared.where(took), contract, F.lit(True)).withColumn("__pid", pid)
        rows = materialize(_resolve_conflicts(rows, base, contract, span, broadcast_bytes)[0])
        go = (F.col("verdict") == "go") & F.col(f"__k_{key[0]}").isNotNull()
        found = {k: F.col(f"__k_{k}") for k in key}
        effects = rows.where(go).select(*_effect_columns(contract, carry, found))
        inserted_keys = effects.where(F.col("cls") == "ins").select(*key)
        refused = rows.where(~go)
        no_key = keyless if contract.surrogate is None else no_key
    else:
        t1 = classify(prepared.where(full), contract, F.lit(True))
        effects = t1.select(*_effect_columns(contract, carry, own_key))
        inserted_keys = t1.where(F.col("cls") == "ins").select(*[own_key[k].alias(k) for k in key])
        if contract.surrogate:
            s = contract.surrogate
            kl = allocate_keys(prepared.where(keyless), base, s, span, broadcast_bytes).withColumnRenamed(s, f"__k_{s}")
            kl = classify(_with_assigned_key(kl, contract, [s]), contract, F.lit(True))
            effects = effects.unionByName(kl.select(*_effect_columns(contract, carry, own_key)))
            inserted_keys = inserted_keys.unionByName(kl.where(F.col("cls") == "ins").select(*[F.col(dv(c)).alias(c) for c in key]))
        else:
            no_key = keyless
        no_key = no_key | by_unique

    prefixes = None
    if len(key) > 1:
        part = classify(prepared.where(partial), contract, F.lit(False))
        if conflicts or hits is not None:
            universe = base.select(*key).unionByName(inserted_keys.select(*key)).distinct()
            expanded = expand_partial(part, universe, contract, broadcast_bytes)
            exp_keys = {k: F.col(f"__k_{k}") for k in key}
            # written once: the fold reads the effects several times, the join runs once
            effects = effects.unionByName(materialize(expanded.select(*_effect_columns(contract, carry, exp_keys))))
        else:
            given = {k: F.coalesce(F.when(a == "set", F.col(dp(k))).otherwise(F.col(rp(k))), F.lit(False)) for k in key}
            prefixes = Prefixes(part, contract, given, {k: F.when(a == "set", F.col(dv(k))).otherwise(F.col(rv(k))) for k in key}, identity, span, broadcast_bytes)

    restricted = ok & (mk == "non_key")
    if hits is not None:
        pred = classify(prepared.where(restricted), contract, F.lit(True))
        named = hits.select(*[F.col(k).alias(f"__k_{k}") for k in key], *[F.col(f"__p_{c}") for c in ("seq", *identity)])
        hit = pred.join(named, [F.col(c) == F.col(f"__p_{c}") for c in ("seq", *identity)])
        effects = effects.unionByName(hit.select(*_effect_columns(contract, carry, {k: F.col(f"__k_{k}") for k in key})))

    by_prefix = None
    if prefixes is not None and prefixes.sets:
        log_keys, most = effect_counts(effects, key, broadcast_bytes)
        prefixes.weigh(log_keys, most)
        direct_rows = fold_with_prefixes(base, effects, base.select(*key).join(log_keys.select(*key), key, "left_semi"), prefixes)
        lives = cache(lambda: materialize(prefixes.lives(base, direct_rows)))
        by_prefix = cache(lambda: materialize(prefixes.outcomes(prefixes.counts(lives()))))

        def folded() -> DataFrame:
            # one row per packet and row hit
            hit = prefixes.hits(lives()).select(*_effect_columns(contract, carry, {k: F.col(f"__k_{k}") for k in key}))
            done = F.when(F.col("cls") == "halt", "quarantined").when(F.col("cls") == "del", "deleted").otherwise("updated")
            hit = hit.withColumns({"live_before": F.lit(True), "outcome": done, "reason": F.when(F.col("cls") == "halt", F.col("pre_reason"))})
            return direct_rows.unionByName(hit, allowMissingColumns=True)

        def table() -> DataFrame:
            return prefixes.table(base, direct_rows)
    else:
        result = fold(base, effects, contract, span, broadcast_bytes)
        folded = direct_rows = result.effects

        def table() -> DataFrame:
            return result.table

    def outcomes() -> DataFrame:
        spread = F.col("match_kind").isin("pk_partial", "non_key")  # packets with any number of effects
        direct = direct_rows.where(~spread).select(
            "seq", "action", "match_kind", *key, "outcome", "reason",
            F.when(F.col("outcome").isin("inserted", "updated", "deleted"), 1).otherwise(0).alias("rows"),
            *_packet_maps(contract, True), *carry,
        )
        if by_prefix is not None:
            part_out = by_prefix().select(
                "seq", "action", "match_kind", *[F.lit(None).cast(contract.type_of(k)).alias(k) for k in key], "outcome", "reason", "rows", *_packet_maps(contract, False), *carry,
            )
        else:
            part_out = spread_outcomes(prepared.where(partial | restricted if hits is not None else partial), folded.where(spread), contract, identity, carry)
        bad = unsaved(
            prepared.where(~ok | no_key | partial_add | (restricted if hits is None else F.lit(False))), contract, carry,
            F.when(restricted, "quarantined").when(ok | (F.col("reject_reason") == "null_key"), "rejected").otherwise("quarantined"),
            F.when(restricted, "needs_barrier").when(ok, "null_key").otherwise(F.col("reject_reason")),
        )
        outcomes = direct.unionByName(part_out).unionByName(bad)
        if refused is not None:
            v, nn = F.col("verdict"), F.coalesce("pre_reason", F.lit("not_null"))
            outcome = F.when(v == "halt_unique", "quarantined").otherwise("rejected")
            reason = F.when(v.isin("duplicate_unique", "halt_unique"), "duplicate_unique").when(v == "duplicate_key", "duplicate_key").otherwise(nn)
            outcomes = outcomes.unionByName(refused.select(
                "seq", "action", "match_kind", *[F.col(f"__k_{k}").alias(k) for k in key], outcome.alias("outcome"), reason.alias("reason"),
                F.lit(0).alias("rows"), *_packet_maps(contract, False), *carry,
            ))
        return outcomes

    res = ChangeResult(outcomes, folded, table, (base, folded, contract), prepared)
    if on_error == "fail":
        stop_at_halt(res.outcomes)
    return res

"""The fold: ordered application of a change log, per key, as window + aggregate work.

Input is one *effect* row per (packet, table row) with a resolved full key ``K``, ``seq`` (unique per
key), ``action``, a fold class ``cls`` and the typed data columns. The only sequential dependency
between packets of a key is one bit, "is the row live", so the fold is a last-non-null prefix scan:

1. every effect gets ``lv`` = True (can insert: add/set with a complete row), False (delete), or NULL;
2. **chunk summaries** per (key, seq bucket): the last non-null ``lv`` (partial aggregation, so a key
   holding a third of the log is combined map-side);
3. **carry** per chunk: last non-null summary of earlier chunks of the key, or "base row exists"
   (window partitioned by key over chunk rows only: at most seq-range / span rows per key);
4. **live before** each effect: window partitioned by (key, bucket) - never more than ``span`` rows
   in one window partition - seeded with the carry row;
5. outcome per effect; final row values per key by ``max_by`` over writes, again partial-aggregated.

Where no key has more than ``span`` effects (counted with the distinct keys of the log), a window per key holds no more
rows than one per bucket would: steps 2 and 3 are left out, and the base row itself is the seed.

No Python UDF, no collect; one full shuffle of the log (step 4).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small, materialize

# Width of a seq bucket: hard bound on the rows of one window partition in step 4.
DEFAULT_SPAN = 1 << 20
MIN_SEQ = -(1 << 63)
BASE_BUCKET = -(1 << 62)

# Fold classes (decided state-free before the fold):
#   ins      add/set carrying a complete, valid row: inserts when the row is not live
#   upd_only set without a required column: updates a live row, rejected otherwise (creates nothing)
#   upd      update
#   del      delete
#   halt     write that would violate NOT NULL / FK on a live row (quarantined), no effect
#   add_bad  add that can never insert (rejected), no effect
FOLD_CLASSES = ("ins", "upd_only", "upd", "del", "halt", "add_bad")


def outcome_of(cls: Column, action: Column, live: Column) -> Column:
    return (
        F.when(cls == "add_bad", "rejected")
        .when((cls == "ins") & (action == "add") & live, "rejected")
        .when((cls == "ins") & ~live, "inserted")
        .when(cls.isin("ins", "upd_only", "upd") & live, "updated")
        .when((cls == "upd_only") & ~live, "rejected")
        .when((cls == "upd") & ~live, "noop")
        .when((cls == "del") & live, "deleted")
        .when(cls == "del", "noop")
        .when((cls == "halt") & live, "quarantined")
        .when((cls == "halt") & (action == "set"), "rejected")
        .otherwise("noop")
    )


def reason_of(cls: Column, action: Column, live: Column, pre: Column) -> Column:
    return (
        F.when(cls == "add_bad", pre)
        .when((cls == "ins") & (action == "add") & live, F.lit("duplicate_key"))
        .when((cls == "upd_only") & ~live, F.coalesce(pre, F.lit("not_null")))
        .when((cls == "halt") & live, pre)
        .when((cls == "halt") & (action == "set"), pre)
    )


def live_before(effects: DataFrame, base_hits: DataFrame, key: list[str], span: int = DEFAULT_SPAN, calm: bool = False) -> DataFrame:
    """Add ``live_before`` and ``b_live`` (row present in the base) to every effect row.

    ``calm``: no key is known to have more than ``span`` effects. ``pd``, if it is a column of ``effects``, is the seq of the last delete before the effect that isn't an effect itself.
    """
    others = "pd" in effects.columns

    def known(live: bool, seq: Column) -> Column:
        return F.struct(seq.cast("long").alias("s"), F.lit(live).alias("v")) if others else F.lit(live)

    lv = F.when(F.col("cls") == "ins", known(True, F.col("seq"))).when(F.col("cls") == "del", known(False, F.col("seq")))
    if calm:
        rows = base_hits.select(*key, F.lit(MIN_SEQ).cast("long").alias("seq"), known(True, F.lit(MIN_SEQ)).alias("lv"), F.lit(True).alias("is_seed"))
        u = effects.withColumns({"lv": lv, "is_seed": F.lit(False)}).unionByName(rows, allowMissingColumns=True)
        w = Window.partitionBy(*key).orderBy("seq", F.desc("is_seed"))
        live = F.coalesce(F.last("lv", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), known(False, F.lit(MIN_SEQ)))
        if others:
            live = live["v"] & ~F.coalesce(F.col("pd") > live["s"], F.lit(False))
        u = u.withColumns({"live_before": live, "b_live": F.max("is_seed").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
        return u.where(~F.col("is_seed")).drop("is_seed", "lv")
    e = effects.withColumn("bkt", F.expr(f"seq div {int(span)}")).withColumn("lv", lv)

    chunks = e.groupBy(*key, "bkt").agg(
        F.max_by("lv", F.when(F.col("lv").isNotNull(), F.col("seq"))).alias("last_lv")
    )
    sentinels = base_hits.select(*key, F.lit(BASE_BUCKET).cast("long").alias("bkt"), known(True, F.lit(MIN_SEQ)).alias("last_lv"))
    w = Window.partitionBy(*key).orderBy("bkt")
    carry = (
        chunks.unionByName(sentinels)
        .select(
            *key,
            "bkt",
            F.coalesce(
                F.last("last_lv", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), known(False, F.lit(MIN_SEQ))
            ).alias("carry"),
            F.max(F.col("bkt") == BASE_BUCKET).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(
                "b_live"
            ),
        )
        .where(F.col("bkt") != BASE_BUCKET)
    )

    seeds = carry.select(
        *key, "bkt", F.lit(MIN_SEQ).cast("long").alias("seq"), F.col("carry").alias("lv"), "b_live", F.lit(True).alias("is_seed")
    )
    u = e.withColumn("b_live", F.lit(None).cast("boolean")).withColumn("is_seed", F.lit(False)).unionByName(
        seeds, allowMissingColumns=True
    )
    wc = Window.partitionBy(*key, "bkt").orderBy("seq")
    live = F.last("lv", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1))
    if others:
        live = live["v"] & ~F.coalesce(F.col("pd") > live["s"], F.lit(False))
    return (
        u.withColumn("live_before", live)
        .withColumn("b_live", F.first("b_live").over(wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where(~F.col("is_seed"))
        .drop("is_seed", "lv", "bkt")
    )


def fold_effects(
    effects: DataFrame, base_hits: DataFrame, contract: TableContract, span: int = DEFAULT_SPAN, calm: bool = False
) -> DataFrame:
    """Per effect row: ``outcome`` in inserted/updated/deleted/noop/rejected/quarantined and ``reason``."""
    key = list(contract.primary_key)
    lb = live_before(effects, base_hits, key, span, calm)
    cls, action, live = F.col("cls"), F.col("action"), F.col("live_before")
    return lb.withColumn("outcome", outcome_of(cls, action, live)).withColumn(
        "reason", reason_of(cls, action, live, F.col("pre_reason"))
    )


def summarize(folded: DataFrame, contract: TableContract) -> DataFrame:
    """Final state per touched key: ``live``, ``base_epoch`` and, per column, written value of the last epoch.

    An epoch starts at an insert or delete; only writes at or after the key's last one survive.
    ``max_by(struct(seq, value), seq)`` keeps an explicit NULL apart from "never written".
    """
    key = list(contract.primary_key)
    o = F.col("outcome")
    boundary = F.when(o.isin("inserted", "deleted"), F.col("seq"))
    aggs = [
        F.max("b_live").alias("b_live"),
        F.max(boundary).alias("e_max"),
        F.max_by(o == "deleted", boundary).alias("last_is_delete"),
    ]
    for c in contract.non_key:
        written = F.when(o.isin("inserted", "updated") & F.col(dp(c)), F.col("seq"))
        aggs.append(F.max_by(F.struct(F.col("seq").alias("s"), F.col(dv(c)).alias("v")), written).alias(f"w__{c}"))
        if contract.has_computed_default(c):
            aggs.append(F.max_by(F.col(f"df__{c}"), F.when(o == "inserted", F.col("seq"))).alias(f"df__{c}"))
    s = folded.groupBy(*key).agg(*aggs)
    cols = [
        *key,
        "b_live",
        F.when(F.col("e_max").isNull(), F.col("b_live")).otherwise(~F.col("last_is_delete")).alias("live"),
        F.col("e_max").isNull().alias("base_epoch"),
    ]
    for c in contract.non_key:
        w = F.col(f"w__{c}")
        cols.append((w.isNotNull() & (w["s"] >= F.coalesce(F.col("e_max"), F.lit(MIN_SEQ)))).alias(f"has__{c}"))
        cols.append(w["v"].alias(f"val__{c}"))
        if contract.has_computed_default(c):
            cols.append(F.col(f"df__{c}"))
    return s.select(*cols)


def _default(contract: TableContract, c: str) -> Column:
    if contract.has_computed_default(c):
        return F.col(f"df__{c}").cast(contract.type_of(c))
    return contract.default(c)


def merge_into_base(
    base: DataFrame, summary: DataFrame, contract: TableContract, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """New snapshot = untouched base rows + surviving touched rows + rows created by the log.

    The per-key summary is materialised and broadcast only when its measured size is within
    ``broadcast_bytes``; then the base is streamed map-side and never shuffled. Beyond it Spark
    plans a sort-merge join.
    """
    key = list(contract.primary_key)
    s = broadcast_if_small(summary, broadcast_bytes) if broadcast_bytes > 0 else summary
    j = base.select(*contract.names).join(s, key, "left")
    touched = F.col("live").isNotNull()
    kept = j.where(~touched | F.col("live"))
    out = [F.col(k) for k in key]
    for c in contract.non_key:
        out.append(
            F.when(~touched, F.col(c))
            .when(F.col(f"has__{c}"), F.col(f"val__{c}"))
            .when(F.col("base_epoch"), F.col(c))
            .otherwise(_default(contract, c))
            .cast(contract.type_of(c))
            .alias(c)
        )
    old_rows = kept.select(*out)
    created = s.where(~F.col("b_live") & F.col("live")).select(
        *key,
        *[
            F.when(F.col(f"has__{c}"), F.col(f"val__{c}")).otherwise(_default(contract, c)).cast(contract.type_of(c)).alias(c)
            for c in contract.non_key
        ],
    )
    return old_rows.unionByName(created).select(*contract.names)


@dataclass
class FoldResult:
    effects: DataFrame  # one row per effect with outcome / reason
    make_table: Callable[[], DataFrame]

    @cached_property
    def table(self) -> DataFrame:
        """The new snapshot; its summary is written once it is read, which rounds that are folded again never do."""
        return self.make_table()


def effect_counts(effects: DataFrame, key: list[str], broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """The distinct keys of the effects with ``__n``, their number of effects (broadcast where small), and the largest of these."""
    keys = effects.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    keys = broadcast_if_small(keys, broadcast_bytes) if broadcast_bytes > 0 else materialize(keys)
    return keys, keys.agg(F.max("__n")).first()[0] or 0


def fold(
    base: DataFrame,
    effects: DataFrame,
    contract: TableContract,
    span: int = DEFAULT_SPAN,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    materialize_effects: bool = True,
) -> FoldResult:
    """Apply resolved full-key effects to ``base``.

    ``base`` rows are only read for keys the log touches (semi join with the distinct log keys,
    broadcast when their measured size allows); untouched rows pass through the final merge.
    """
    key = list(contract.primary_key)
    log_keys, most = effect_counts(effects, key, broadcast_bytes)
    hits = base.select(*key).join(log_keys.select(*key), key, "left_semi")
    folded = fold_effects(effects, hits, contract, span, most <= span)
    if materialize_effects:
        # written once to the checkpoint folder: outcomes and the summary both read it, and the
        # plans built on top of it stay small
        folded = materialize(folded)
    return FoldResult(folded, lambda: merge_into_base(base, summarize(folded, contract), contract, broadcast_bytes))

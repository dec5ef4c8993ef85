"""Keys: profiling declared keys on data (K1) and gapless surrogate allocation in seq order (K3/K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small, materialize, measured_bytes

DEFAULT_SPAN = 1 << 20


def profile_keys(df: DataFrame, candidates: list[tuple[str, ...]]) -> DataFrame:
    """Prove candidate keys on data: rows, rows with a NULL key column, duplicate key groups.

    All candidates in one scan: ``groupingSets`` expands each row once per candidate, the partial
    aggregation combines map-side, then a second aggregate counts groups per candidate.
    Output: candidate (comma-joined columns), rows, null_rows, duplicate_groups, is_key.
    """
    cols = sorted({c for cand in candidates for c in cand})
    rows = df.select(*cols)
    counted = rows.groupingSets([[F.col(c) for c in cand] for cand in candidates], *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n")
    )
    labels = F.create_map(*[x for cand in candidates for x in (F.lit(_gid(cols, cand)), F.lit(",".join(cand)))])
    any_null = {
        _gid(cols, cand): " OR ".join(f"`{c}` IS NULL" for c in cand) for cand in candidates
    }
    null_expr = F.lit(False)
    for gid, cond in any_null.items():
        null_expr = F.when(F.col("gid") == gid, F.expr(cond)).otherwise(null_expr)
    per_group = counted.select(labels[F.col("gid")].alias("candidate"), "n", null_expr.alias("has_null"))
    return per_group.groupBy("candidate").agg(
        F.sum("n").cast("long").alias("rows"),
        F.sum(F.when(F.col("has_null"), F.col("n")).otherwise(0)).cast("long").alias("null_rows"),
        F.count(F.when(~F.col("has_null") & (F.col("n") > 1), 1)).cast("long").alias("duplicate_groups"),
    ).withColumn("is_key", (F.col("null_rows") == 0) & (F.col("duplicate_groups") == 0))


def _gid(cols: list[str], cand: tuple[str, ...]) -> int:
    """grouping_id(): bit set (most significant first) for every grouping column NOT in the set."""
    gid = 0
    for c in cols:
        gid = (gid << 1) | (0 if c in cand else 1)
    return gid


def rank_by_seq(df: DataFrame, span: int = DEFAULT_SPAN, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Add ``rank`` = 1-based position of each row in ``seq`` order, without a one-partition window; rows without seq have none.

    Only the seqs are ranked: a table of one narrow row per seq, bucketed by seq range. Bucket sizes (partial aggregate) are
    prefix-summed in two levels (buckets within a super bucket, then super buckets), the offsets joined back, and a window
    partitioned by bucket numbers the seqs inside it (at most ``span`` of them per window partition). The rows themselves,
    however wide, get their rank by a join on seq and go through no window, except rows that share a seq.
    """
    seqs = df.where(F.col("seq").isNotNull()).groupBy(F.col("seq").alias("__at")).agg(F.count(F.lit(1)).alias("__k"))
    b = seqs.withColumn("__bkt", F.expr(f"__at div {int(span)}"))
    counts = b.groupBy("__bkt").agg(F.sum("__k").alias("__n")).withColumn("__sb", F.expr("__bkt div 4096"))
    inner = Window.partitionBy("__sb").orderBy("__bkt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__off_in", F.coalesce(F.sum("__n").over(inner), F.lit(0)))
    supers = counts.groupBy("__sb").agg(F.sum("__n").alias("__sn"))
    # one row per 4096 buckets (= 2^32 seq values at the default span): tiny
    outer = Window.orderBy("__sb").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.withColumn("__off_sb", F.coalesce(F.sum("__sn").over(outer), F.lit(0)))
    offsets = counts.join(supers, "__sb").select("__bkt", (F.col("__off_in") + F.col("__off_sb")).alias("__off"))
    offsets = broadcast_if_small(offsets, broadcast_bytes) if broadcast_bytes > 0 else offsets
    w = Window.partitionBy("__bkt").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__off") + F.coalesce(F.sum("__k").over(w), F.lit(0))
    ranks = materialize(b.join(offsets, "__bkt").select("__at", "__k", before.alias("__before")))
    shared = not ranks.where("__k > 1").isEmpty()
    if 0 < measured_bytes(ranks) <= broadcast_bytes:
        ranks = F.broadcast(ranks)
    place = F.row_number().over(Window.partitionBy("seq").orderBy("seq")) if shared else F.lit(1)
    ranked = df.join(ranks.drop("__k"), F.col("seq") == F.col("__at"))
    return ranked.withColumn("rank", (F.col("__before") + place).cast("long")).drop("__at", "__before")


def allocate_keys(
    packets: DataFrame,
    base: DataFrame,
    surrogate: str,
    span: int = DEFAULT_SPAN,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Give keyless inserts a surrogate id: max(id) of the table + rank in seq order (gapless).

    A database sequence would burn a value for a failed insert; here ids are dense by seq.
    """
    start = base.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long").alias("__start")).withColumn("__one", F.lit(1))
    ranked = rank_by_seq(packets, span, broadcast_bytes).withColumn("__one", F.lit(1))
    # one-row scalar joined on a constant: a broadcast hash join, not a pairing of rows
    return ranked.join(F.broadcast(start), "__one").withColumn(surrogate, F.col("__start") + F.col("rank")).drop(
        "__start", "rank", "__one"
    )

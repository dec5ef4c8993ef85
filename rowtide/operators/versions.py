"""Rows over time: which rows does a restriction hit, as of its packet?

A restriction on columns that the log itself writes can't be folded per key: the rows that it hits depend on earlier
packets. It is still local to a row, though, so it is answered from the row's versions:

1. The folded effects give, per row, the values of the restricted columns after every change: a last-non-null scan,
   chunked by seq like the fold's liveness scan where a key has more than ``span`` changes, so that a hot key never
   fills one window partition.
2. Consecutive changes bound the intervals ``(lo, hi]`` in which the values stand; the base row gives the interval
   before the first change, and for untouched rows the only one.
3. Restrictions are grouped by their values into sorted arrays of seqs (chunked as well) and met with the intervals by
   one equi-join per set of restricted columns; the seqs inside an interval are the hits.

Nothing here depends on the number of packets: no packet is read by the driver, and none costs a job of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv
from rowtide.operators.fold import BASE_BUCKET, DEFAULT_SPAN, MIN_SEQ
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small, materialize

MAX_SEQ = (1 << 63) - 1
SEQS_PER_ROW = 1 << 16  # seqs of restrictions with one value that travel in one array


def qp(c: str) -> str:
    """``c`` is restricted"""
    return f"qp__{c}"


def qv(c: str) -> str:
    """value that ``c`` is restricted to"""
    return f"q__{c}"


def changes(folded: DataFrame, contract: TableContract, cols: list[str]) -> DataFrame:
    """Applied effects that change a row's life or one of ``cols``: key, seq, ``live``, ``s__<c>`` (null: unchanged)."""
    o = F.col("outcome")
    marks = []
    for c in cols:
        default = F.col(f"df__{c}").cast(contract.type_of(c)) if contract.has_computed_default(c) else contract.default(c)
        born = F.struct(F.when(F.col(dp(c)), F.col(dv(c))).otherwise(default).alias("v"))
        marks.append(F.when(o == "inserted", born).when((o == "updated") & F.col(dp(c)), F.struct(F.col(dv(c)).alias("v"))).alias(f"s__{c}"))
    live = F.when(o == "inserted", True).when(o == "deleted", False).alias("live")
    some = reduce(lambda a, b: a | b, [F.col(f"s__{c}").isNotNull() for c in cols], F.col("live").isNotNull())
    return folded.select(*contract.primary_key, "seq", live, *marks).where(some)


def version_intervals(base: DataFrame, folded: DataFrame, contract: TableContract, cols: list[str], span: int = DEFAULT_SPAN,
                      broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``key, cols, lo, hi``: the values of every live row, standing for packets with ``lo < seq <= hi``.

    ``cols`` may name key columns; these never change.
    """
    key = list(contract.primary_key)
    moving = [c for c in cols if c not in key]
    scan = ["live", *[f"s__{c}" for c in moving]]
    e = materialize(changes(folded, contract, moving).withColumn("bkt", F.expr(f"seq div {int(span)}")))

    firsts = e.groupBy(*key).agg(F.min("seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    firsts = broadcast_if_small(firsts, broadcast_bytes) if broadcast_bytes > 0 else materialize(firsts)
    calm = (firsts.agg(F.max("__n")).first()[0] or 0) <= span
    rows = base.select(*key, *moving).join(firsts.drop("__n"), key, "left")
    shown = [*key, *moving]
    before = rows.select(*shown, F.lit(MIN_SEQ).cast("long").alias("lo"), F.coalesce("__first", F.lit(MAX_SEQ)).alias("hi"))

    if calm:
        start = rows.where(F.col("__first").isNotNull()).select(
            *key, F.lit(MIN_SEQ).cast("long").alias("seq"), F.lit(True).alias("live"),
            *[F.struct(F.col(c).cast(contract.type_of(c)).alias("v")).alias(f"s__{c}") for c in moving], F.lit(True).alias("is_seed"),
        )
        u = e.drop("bkt").withColumn("is_seed", F.lit(False)).unionByName(start)
        w = Window.partitionBy(*key).orderBy("seq", F.desc("is_seed"))
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        next_seq = F.coalesce(F.lead("seq").over(w), F.lit(MAX_SEQ)).alias("hi")
        after = u.select(*key, "is_seed", F.col("seq").alias("lo"), *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in scan], next_seq)
        after = after.where(~F.col("is_seed") & F.coalesce("live", F.lit(False)))
        return before.unionByName(after.select(*key, *[F.col(f"s__{c}")["v"].alias(c) for c in moving], "lo", "hi"))

    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in scan]
    chunks = e.groupBy(*key, "bkt").agg(*last, F.min("seq").alias("first_seq"))
    start = rows.where(F.col("__first").isNotNull()).select(
        *key, F.lit(BASE_BUCKET).cast("long").alias("bkt"), F.lit(True).alias("live"),
        *[F.struct(F.col(c).cast(contract.type_of(c)).alias("v")).alias(f"s__{c}") for c in moving], F.lit(None).cast("long").alias("first_seq"),
    )
    w = Window.partitionBy(*key).orderBy("bkt")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.unionByName(start).select(
        *key, "bkt", *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in scan], F.lead("first_seq").over(w).alias("next_seq"),
    ).where(F.col("bkt") != BASE_BUCKET)
    seeds = carried.select(*key, "bkt", F.lit(MIN_SEQ).cast("long").alias("seq"), *scan, "next_seq", F.lit(True).alias("is_seed"))
    u = e.withColumn("next_seq", F.lit(None).cast("long")).withColumn("is_seed", F.lit(False)).unionByName(seeds)
    wc = Window.partitionBy(*key, "bkt").orderBy("seq")
    so_far = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = u.select(
        *key, "is_seed", F.col("seq").alias("lo"), *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in scan],
        F.coalesce(F.lead("seq").over(wc), F.first("next_seq").over(so_far), F.lit(MAX_SEQ)).alias("hi"),
    ).where(~F.col("is_seed") & F.coalesce("live", F.lit(False)))
    after = after.select(*key, *[F.col(f"s__{c}")["v"].alias(c) for c in moving], "lo", "hi")
    return before.unionByName(after)


def patterns(predicates: DataFrame, contract: TableContract) -> list[list[str]]:
    """The sets of restricted columns that occur (as many rows as there are such sets, not packets)."""
    flags = predicates.select(*[F.col(qp(c)) for c in contract.names]).distinct().collect()
    return sorted([c for c in contract.names if r[qp(c)]] for r in flags)


def match(intervals: DataFrame, predicates: DataFrame, contract: TableContract, cols: list[str], names: list[str],
          broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``key`` of the rows and ``names`` (seq first) of the packets whose restriction on exactly ``cols`` hits them.

    SQL equality: NULL restricts to nothing.
    """
    key = list(contract.primary_key)
    exact = reduce(lambda a, b: a & b, [F.col(qp(c)) if c in cols else ~F.col(qp(c)) for c in contract.names])
    given = predicates.where(exact).select(*[F.col(qv(c)).alias(f"__q_{c}") for c in cols], F.struct(*[F.col(n) for n in names]).alias("p"))
    lists = given.groupBy(*[f"__q_{c}" for c in cols], F.expr(f"p.seq div {SEQS_PER_ROW}").alias("__part")).agg(F.collect_list("p").alias("ps")).drop("__part")
    lists = broadcast_if_small(lists, broadcast_bytes) if broadcast_bytes > 0 else lists
    met = intervals.join(lists, [F.col(c) == F.col(f"__q_{c}") for c in cols])
    inside = F.filter("ps", lambda p: (p["seq"] > F.col("lo")) & (p["seq"] <= F.col("hi")))
    return met.select(*key, F.explode(inside).alias("p")).select(*key, *[F.col(f"p.{n}").alias(f"__p_{n}") for n in names])


def base_hits(base: DataFrame, predicates: DataFrame, contract: TableContract, sets: list[list[str]], names: list[str],
              broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """All (row, packet) hits of ``predicates`` if the log changed nothing: the first guess of the rounds."""
    cols = sorted({c for s in sets for c in s} - set(contract.primary_key))
    always = base.select(*contract.primary_key, *cols, F.lit(MIN_SEQ).cast("long").alias("lo"), F.lit(MAX_SEQ).cast("long").alias("hi"))
    return materialize(reduce(lambda a, b: a.unionByName(b), [match(always, predicates, contract, s, names, broadcast_bytes) for s in sets]))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Do both hold the same rows, each as often? One shuffle."""
    sides = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
    return sides.groupBy(*a.columns).agg(F.sum("__side").alias("__more")).where("__more <> 0").isEmpty()


def find_hits(base: DataFrame, folded: DataFrame, predicates: DataFrame, contract: TableContract, sets: list[list[str]], names: list[str],
              span: int = DEFAULT_SPAN, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """All (row, packet) hits of ``predicates`` on the versions of the rows, written once."""
    cols = sorted({c for s in sets for c in s})
    intervals = version_intervals(base, folded, contract, cols, span, broadcast_bytes)
    if len(sets) > 1:
        intervals = materialize(intervals)
    parts = [match(intervals, predicates, contract, s, names, broadcast_bytes) for s in sets]
    return materialize(reduce(lambda a, b: a.unionByName(b), parts))


def with_restriction(packets: DataFrame, contract: TableContract, of: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds the restriction columns: ``of`` gives (is restricted, value) per column; other columns aren't restricted."""
    out = {}
    for c, t in contract.columns:
        given, value = of.get(c, (F.lit(False), F.lit(None)))
        out[qp(c)], out[qv(c)] = F.coalesce(given, F.lit(False)), value.cast(t)
    return packets.withColumns(out)

"""Packets that name a part of a composite key, in space linear in rows plus packets.

Such a packet hits every row below its prefix, but what it does to a row can be looked up instead of being written out per row:

1. Only partial *deletes* change who is live. The last one before each full-key effect (an as-of scan, chunked by seq so that
   a hot prefix never fills one window partition) goes into the liveness scan of the fold.
2. A row's final values are the last of its own writes and of the last partial write per prefix and column, after the row's
   last birth: one summary row per prefix, joined with the base.
3. How many rows a packet hits is the number of births minus deaths below its prefix before it: running sums over seq.

Which rows a packet hits is a join of the packets with the rows' lives; it is only run if it is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.functions.packets import dp, dv
from rowtide.operators.fold import MIN_SEQ, _default, fold_effects
from rowtide.session import broadcast_if_small, materialize


def _bucket(span: int) -> Column:
    return F.expr(f"seq div {int(span)}")


def _scan(events: DataFrame, marks: DataFrame, by: list[str], span: int, value: Column, chunk: Column, over: Column, last: bool, calm: bool) -> DataFrame:
    """``events`` with ``__found``: ``over`` of the marks' values before (``last``) or after them in order of seq, per ``by``.

    ``calm``: no value of ``by`` is known to have more than ``span`` rows, so that one window per value is enough.
    """
    u = events.withColumn("__m", F.lit(None).cast("long")).unionByName(marks.select(*by, "seq", value.cast("long").alias("__m")), allowMissingColumns=True)
    u = u.withColumn("bkt", _bucket(span)).withColumn("__is_mark", F.col("__m").isNotNull())
    order = F.asc if last else F.desc
    if calm:
        w = Window.partitionBy(*by).orderBy(order("seq"), "__is_mark").rowsBetween(Window.unboundedPreceding, -1)
        return u.withColumn("__found", over.over(w)).where(~F.col("__is_mark")).drop("__m", "bkt", "__is_mark")
    chunks = u.groupBy(*by, "bkt").agg(chunk.alias("__m"))
    w = Window.partitionBy(*by).orderBy(order("bkt")).rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*by, "bkt", over.over(w).alias("__carry"))
    edge = MIN_SEQ if last else (1 << 63) - 1
    seeds = carried.select(*by, "bkt", F.lit(edge).cast("long").alias("seq"), F.col("__carry").alias("__m"), F.lit(True).alias("__is_mark"))
    wc = Window.partitionBy(*by, "bkt").orderBy(order("seq"), "__is_mark").rowsBetween(Window.unboundedPreceding, -1)
    full = u.unionByName(seeds, allowMissingColumns=True).withColumn("__found", over.over(wc))
    return full.where(~F.col("__is_mark")).drop("__m", "bkt", "__is_mark")


def last_before(events: DataFrame, marks: DataFrame, by: list[str], span: int, calm: bool = False) -> DataFrame:
    """``__found``: the largest seq of ``marks`` below the event's."""
    return _scan(events, marks, by, span, F.col("seq"), F.max("__m"), F.max("__m"), True, calm)


def first_after(events: DataFrame, marks: DataFrame, by: list[str], span: int, calm: bool = False) -> DataFrame:
    """``__found``: the smallest seq of ``marks`` above the event's."""
    return _scan(events, marks, by, span, F.col("seq"), F.min("__m"), F.min("__m"), False, calm)


def sum_before(events: DataFrame, deltas: DataFrame, by: list[str], span: int, calm: bool = False) -> DataFrame:
    """``__found``: the sum of ``deltas.__n`` below the event's seq."""
    return _scan(events, deltas, by, span, F.col("__n"), F.sum("__m"), F.sum("__m"), True, calm)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)  # NULLs are skipped


class Prefixes:
    """The partial packets of a log by the set of key columns that they name.

    ``partial``: classified packets; ``given`` / ``value``: per key column whether it is named, and its value.
    """

    def __init__(self, partial: DataFrame, contract: TableContract, given: dict[str, Column], value: dict[str, Column], identity: tuple[str, ...], span: int, broadcast_bytes: int):
        self.contract, self.key, self.span, self.bytes = contract, list(contract.primary_key), span, broadcast_bytes
        self.names = ["seq", *identity]
        named = partial.select(*partial.columns, *[given[k].alias(f"__g_{k}") for k in self.key], *[value[k].alias(f"__v_{k}") for k in self.key])
        self.packets = named  # columns of an aligned log that is written already
        flags = self.packets.select(*[F.col(f"__g_{k}") for k in self.key]).distinct().collect()  # at most 2^columns rows
        self.sets = sorted([k for k in self.key if r[f"__g_{k}"]] for r in flags)
        self.sums = {tuple(cols): self._small(self._summary(cols)) for cols in self.sets}
        self.calm: dict[tuple[str, ...], bool] = {}

    def _summary(self, cols: list[str]) -> DataFrame:
        """Per prefix: number of packets, first and last delete, the last write of every column."""
        writes = [F.max_by(F.struct(F.col("seq").alias("s"), F.col(dv(c)).alias("v")), F.when(F.col("cls").isin("upd", "upd_only") & F.col(dp(c)), F.col("seq"))).alias(f"p__{c}") for c in self.contract.non_key]
        gone = F.when(F.col("cls") == "del", F.col("seq"))
        return self.of(cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"), F.min(gone).alias("__d_first"), F.max(gone).alias("__d"), *writes)

    def weigh(self, effect_keys: DataFrame, most: int) -> None:
        """Find out which scans need no chunks: ``effect_keys`` with their number ``__n`` of full-key effects, at most ``most``.

        A prefix sees its packets, its effects, and at most a birth and a death for each of these, one birth for all base rows.
        """
        self.calm = {tuple(self.key): most <= self.span}
        for cols in self.sets:
            rows = effect_keys.select(*cols, (2 * F.col("__n")).alias("__n")).unionByName(self.sums[tuple(cols)].select(*cols, (2 * F.col("__n")).alias("__n")))
            top = rows.groupBy(*cols).agg(F.sum("__n").alias("__n")).agg(F.max("__n")).first()[0] or 0
            self.calm[tuple(cols)] = top < self.span

    def _is_calm(self, cols: list[str]) -> bool:
        return self.calm.get(tuple(cols), False)

    def of(self, cols: list[str]) -> DataFrame:
        """Packets that name exactly ``cols``, with these as columns."""
        exact = reduce(lambda a, b: a & b, [F.col(f"__g_{k}") == F.lit(k in cols) for k in self.key])
        rest = [c for c in self.packets.columns if not c.startswith(("__g_", "__v_")) and c not in cols]
        return self.packets.where(exact).select(*[F.col(f"__v_{k}").alias(k) for k in cols], *rest)

    def deletes(self, cols: list[str]) -> DataFrame:
        return self.of(cols).where(F.col("cls") == "del").select(*cols, "seq")

    def with_last_delete(self, effects: DataFrame) -> DataFrame:
        """Adds ``pd``: the last partial delete of the row before the effect."""
        out = effects.withColumn("pd", F.lit(None).cast("long"))
        for cols in self.sets:
            out = last_before(out, self.deletes(cols), cols, self.span, self._is_calm(cols)).withColumn("pd", F.greatest("pd", "__found")).drop("__found")
        return out

    def _small(self, df: DataFrame) -> DataFrame:
        return broadcast_if_small(df, self.bytes) if self.bytes > 0 else df

    def table(self, base: DataFrame, folded: DataFrame) -> DataFrame:
        """The new snapshot: base rows and rows created by full-key effects, with the partial packets' last writes."""
        contract, key = self.contract, self.key
        o = F.col("outcome")
        edge = F.when(o.isin("inserted", "deleted"), F.col("seq"))
        aggs = [F.max("b_live").alias("b_live"), F.max(edge).alias("e_max"), F.max_by(o == "deleted", edge).alias("__gone")]
        for c in contract.non_key:
            written = F.when(o.isin("inserted", "updated") & F.col(dp(c)), F.col("seq"))
            aggs.append(F.max_by(F.struct(F.col("seq").alias("s"), F.col(dv(c)).alias("v")), written).alias(f"w__{c}"))
            if contract.has_computed_default(c):
                aggs.append(F.max_by(F.col(f"df__{c}"), F.when(o == "inserted", F.col("seq"))).alias(f"df__{c}"))
        own = self._small(folded.groupBy(*key).agg(*aggs))
        old = base.select(*contract.names).join(own, key, "left").withColumn("__old", F.lit(True))
        new = own.where(~F.col("b_live") & F.col("e_max").isNotNull()).withColumn("__old", F.lit(False))
        rows = old.unionByName(new, allowMissingColumns=True)
        # birth: where the row's present life begins; the base row's life began before all packets
        rows = rows.withColumn("__birth", F.coalesce("e_max", F.lit(MIN_SEQ))).withColumn("__dmax", F.lit(None).cast("long"))
        best = {c: F.when(F.col(f"w__{c}.s") >= F.col("__birth"), F.col(f"w__{c}")) for c in contract.non_key}
        rows = rows.withColumns({f"b__{c}": best[c] for c in best})
        for cols in self.sets:
            seen = self.sums[tuple(cols)].drop("__n", "__d_first")
            rows = rows.join(seen, cols, "left").withColumn("__dmax", F.greatest("__dmax", "__d"))
            for c in contract.non_key:
                later = F.col(f"p__{c}.s") > F.coalesce(F.col(f"b__{c}.s"), F.col("__birth"))
                rows = rows.withColumn(f"b__{c}", F.when(F.coalesce(later, F.lit(False)), F.col(f"p__{c}")).otherwise(F.col(f"b__{c}")))
            rows = rows.drop("__d", *[f"p__{c}" for c in contract.non_key])
        alive = ~F.coalesce("__gone", F.lit(False)) & ~F.coalesce(F.col("__dmax") > F.col("__birth"), F.lit(False))
        first = F.col("__old") & F.col("e_max").isNull()
        out = [F.when(F.col(f"b__{c}").isNotNull(), F.col(f"b__{c}.v")).when(first, F.col(c)).otherwise(_default(contract, c)).cast(contract.type_of(c)).alias(c) for c in contract.non_key]
        return rows.where(alive).select(*key, *out).select(*contract.names)

    def lives(self, base: DataFrame, folded: DataFrame) -> DataFrame:
        """``key, __birth, __death`` (NULL: none) of every life of every row that a partial packet could hit."""
        key = self.key
        ends = folded.where(F.col("outcome") == "deleted").select(*key, "seq")
        born = folded.where(F.col("outcome") == "inserted").select(*key, "seq")
        born = first_after(born, ends, key, self.span, self._is_calm(key)).withColumnRenamed("__found", "__death")
        first = base.select(*key).join(self._small(ends.groupBy(*key).agg(F.min("seq").alias("__death"))), key, "left")
        first = first.withColumns({"seq": F.lit(MIN_SEQ).cast("long"), "__named": F.lit(False)})
        for cols in self.sets:
            born = first_after(born, self.deletes(cols), cols, self.span, self._is_calm(cols)).withColumn("__death", _least(F.col("__death"), F.col("__found"))).drop("__found")
            earliest = self.sums[tuple(cols)].select(*cols, F.col("__d_first").alias("__found"), F.lit(True).alias("__hit"))
            first = first.join(earliest, cols, "left")
            first = first.withColumns({"__death": _least(F.col("__death"), F.col("__found")), "__named": F.col("__named") | F.col("__hit").isNotNull()}).drop("__found", "__hit")
        first = first.where("__named").drop("__named")
        return first.unionByName(born).select(*key, F.col("seq").alias("__birth"), "__death")

    def counts(self, lives: DataFrame) -> DataFrame:
        """``names`` of every partial packet and ``rows``: how many live rows it finds."""
        parts = []
        for cols in self.sets:
            packets = self.of(cols).select(*cols, *self.names)
            below = lives.join(self.sums[tuple(cols)].select(*cols), cols, "left_semi")
            ends = F.array(F.struct(F.col("__birth").alias("seq"), F.lit(1).alias("__n")), F.struct(F.col("__death").alias("seq"), F.lit(-1).alias("__n")))
            deltas = below.select(*cols, F.inline(ends)).where("seq is not null").groupBy(*cols, "seq").agg(F.sum("__n").alias("__n"))
            parts.append(sum_before(packets, deltas, cols, self.span, self._is_calm(cols)).select(*self.names, F.coalesce("__found", F.lit(0)).alias("rows")))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def hits(self, lives: DataFrame) -> DataFrame:
        """One row per packet and row that it hits: the packets' columns and the key. As large as its result."""
        parts = []
        for cols in self.sets:
            others = [k for k in self.key if k not in cols]
            met = self.of(cols).join(lives, cols).where((F.col("seq") > F.col("__birth")) & (F.col("__death").isNull() | (F.col("seq") <= F.col("__death"))))
            parts.append(met.drop("__birth", "__death").withColumns({f"__k_{k}": F.col(k) for k in self.key}).drop(*cols, *others))
        return reduce(lambda a, b: a.unionByName(b), parts)


    def outcomes(self, counts: DataFrame) -> DataFrame:
        """Columns of the packets, ``outcome``, ``reason`` and ``rows``."""
        found = counts.select(*[F.col(n).alias(f"__c_{n}") for n in self.names], F.col("rows"))
        p = self.packets.join(found, [F.col(n) == F.col(f"__c_{n}") for n in self.names])
        cls, a, n = F.col("cls"), F.col("action"), F.col("rows")
        outcome = F.when(n == 0, F.when(a == "set", "rejected").otherwise("noop")).when(cls == "halt", "quarantined").when(cls == "del", "deleted").otherwise("updated")
        reason = F.when((n == 0) & (a == "set"), "partial_key").when((n > 0) & (cls == "halt"), F.col("pre_reason"))
        return p.withColumns({"outcome": outcome, "reason": reason, "rows": F.when(outcome.isin("updated", "deleted"), n).otherwise(F.lit(0))})


def fold_with_prefixes(base: DataFrame, effects: DataFrame, base_hits: DataFrame, prefixes: Prefixes) -> DataFrame:
    """Outcomes of the full-key effects among partial deletes, written once."""
    return materialize(fold_effects(prefixes.with_last_delete(effects), base_hits, prefixes.contract, prefixes.span, prefixes._is_calm(prefixes.key)).drop("pd"))

"""Counters per worker and their time series (samples, deltas, recent window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTERS = ("add", "delete", "set", "update", "errors", "rejects")


def _counter_columns() -> list[Column]:
    a, o = F.col("action"), F.col("outcome")
    return [
        F.count_if(a == "add").alias("add"),
        F.count_if(a == "delete").alias("delete"),
        F.count_if(a == "set").alias("set"),
        F.count_if(a == "update").alias("update"),
        # the reference counts only failed plain inserts as errors (a failed insert inside set is not)
        F.count_if((a == "add") & (o == "rejected")).alias("errors"),
        F.count_if(o.isin("rejected", "quarantined")).alias("rejects"),
    ]


def worker_stats(outcomes: DataFrame) -> DataFrame:
    """Attempts per action (rejected included), errors and rejects per ``worker``."""
    return outcomes.groupBy("worker").agg(*_counter_columns())


def _chunk() -> Column:
    """Samples are chunked by day: no window partition holds more than one worker-day of samples."""
    return F.date_trunc("day", F.col("sample_ts"))


def sample_stats(outcomes: DataFrame, interval: str = "1 second", ts: str = "ts") -> DataFrame:
    """Cumulative counters per worker sampled at the end of each tumbling ``interval``.

    Interval counts come from a tumbling ``window`` aggregate (partial-aggregated). The running total
    is two-level: day totals are prefix-summed per worker (one row per worker-day), then a window
    inside each worker-day adds the offset.
    """
    per = outcomes.groupBy("worker", F.window(ts, interval).alias("w")).agg(*_counter_columns())
    per = per.select("worker", F.col("w.end").alias("sample_ts"), *COUNTERS).withColumn("__day", _chunk())
    days = per.groupBy("worker", "__day").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    before = Window.partitionBy("worker").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = days.select("worker", "__day", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__o_{c}") for c in COUNTERS])
    inside = Window.partitionBy("worker", "__day").orderBy("sample_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.join(offsets, ["worker", "__day"]).select(
        "worker", "sample_ts", *[(F.sum(c).over(inside) + F.col(f"__o_{c}")).cast("long").alias(c) for c in COUNTERS]
    )


def counter_deltas(samples: DataFrame) -> DataFrame:
    """Each counter minus its previous sample of the worker; the first sample gives no point.

    The previous sample of a day's first sample is the last sample of the worker's previous
    non-empty day (``max_by`` per worker-day, then a lag over day rows only).
    """
    s = samples.withColumn("__day", _chunk())
    last = s.groupBy("worker", "__day").agg(F.max_by(F.struct(*COUNTERS), "sample_ts").alias("__last"))
    prev_day = Window.partitionBy("worker").orderBy("__day")
    carry = last.select("worker", "__day", F.lag("__last").over(prev_day).alias("__prev"))
    w = Window.partitionBy("worker", "__day").orderBy("sample_ts")
    j = s.join(carry, ["worker", "__day"])
    d = j.select(
        "worker", "sample_ts",
        *[(F.col(c) - F.coalesce(F.lag(c).over(w), F.col(f"__prev.{c}"))).alias(c) for c in COUNTERS],
    )
    return d.where(F.col(COUNTERS[0]).isNotNull())


def recent(points: DataFrame, n: int = 300) -> DataFrame:
    """The last ``n`` points per worker (top-k per group; the limit is the feature).

    ``row_number() <= n`` lets Spark keep only the top ``n`` per worker in each task before the
    shuffle (window group limit), so a worker's whole history never meets in one task.
    """
    w = Window.partitionBy("worker").orderBy(F.col("sample_ts").desc())
    return points.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")

"""Table snapshots: versions of buckets of rows, committed by markers.

Rows are dealt to buckets by a hash of their key. Version ``n`` writes only the buckets that it changes, below
``<root>/data/v=<n>``; its commit marker ``<root>/_progress/v=<n>``, written after the data, names for every bucket the version
that holds it (-1: the bucket is empty). Readers see the highest committed version, and read only the buckets they ask for.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.contract import TableContract

BUCKETS = 64
BUCKET = "__bucket"
_MARK = "v int, max_seq bigint, stream string, batch bigint, buckets array<int>, row_schema string, offsets map<string,bigint>"


def read_table(spark: SparkSession, path: str, contract: TableContract | None = None) -> DataFrame:
    """Scan a table (Parquet file or folder) and project it onto the contract's columns and types."""
    df = spark.read.parquet(path)
    if contract is None:
        return df
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.columns])


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


@dataclass
class Mark:
    """A committed version: which version holds each bucket, the rows' schema, the largest seq, how far each target has come."""

    version: int
    buckets: list[int]
    row_schema: str
    max_seq: int | None = None
    offsets: dict[str, int] = field(default_factory=dict)


def _marks(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MARK).parquet(f"{root.rstrip('/')}/_progress")
    except AnalysisException:
        return None


def current_mark(spark: SparkSession, root: str, version: int | None = None) -> Mark | None:
    """The highest committed version, or the given one."""
    marks = _marks(spark, root)
    if marks is None:
        return None
    marks = marks if version is None else marks.where(F.col("v") == version)
    row = marks.orderBy(F.desc("v")).limit(1).collect()
    return Mark(row[0]["v"], list(row[0]["buckets"]), row[0]["row_schema"], row[0]["max_seq"], dict(row[0]["offsets"] or {})) if row else None


def current_version(spark: SparkSession, root: str) -> int | None:
    mark = current_mark(spark, root)
    return None if mark is None else mark.version


def applied(spark: SparkSession, root: str, stream: str, batch: int) -> bool:
    """Has this micro-batch of this stream been committed?"""
    marks = _marks(spark, root)
    return marks is not None and not marks.where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()


def write_snapshot(
    df: DataFrame, root: str, version: int, key: list[str], *, before: Mark | None = None, touched: list[int] | None = None, buckets: int = BUCKETS,
    max_seq: int | None = None, stream: str | None = None, batch: int | None = None, offsets: dict[str, int] | None = None,
) -> Mark:
    """Write the ``touched`` buckets (None: all) of ``df`` as version ``version``, then its commit marker.

    The other buckets stay where ``before`` has them. Rewriting a version (a replayed batch) is idempotent.
    """
    root, spark = root.rstrip("/"), df.sparkSession
    n = len(before.buckets) if before else buckets
    touched = list(range(n)) if touched is None or before is None else sorted(touched)
    rows = df.withColumn(BUCKET, bucket_of(key, n))
    if len(touched) < n:
        rows = rows.where(F.col(BUCKET).isin(touched)) if touched else rows.limit(0)
    path = f"{root}/data/v={int(version)}"
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    held = list(before.buckets) if before else [-1] * n
    written = spark.read.schema(f"{BUCKET} int").parquet(path).select(BUCKET).distinct().collect() if touched else []  # at most n rows
    for b in touched:
        held[b] = -1
    for r in written:
        held[r[BUCKET]] = int(version)
    mark = Mark(int(version), held, df.schema.json(), max_seq, offsets or {})
    row = (int(version), max_seq, stream, batch, held, mark.row_schema, mark.offsets)
    spark.createDataFrame([row], _MARK).coalesce(1).drop("v").write.mode("overwrite").parquet(f"{root}/_progress/v={int(version)}")
    return mark


def read_snapshot(spark: SparkSession, root: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version (default: the current one), of all buckets or of the given ones."""
    mark = current_mark(spark, root, version)
    if mark is None:
        raise FileNotFoundError(f"no committed snapshot under {root}")
    schema = T.StructType.fromJson(json.loads(mark.row_schema))
    asked = range(len(mark.buckets)) if buckets is None else buckets
    paths = [f"{root.rstrip('/')}/data/v={mark.buckets[b]}/{BUCKET}={b}" for b in asked if mark.buckets[b] >= 0]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)

"""Session helpers: local session for tests/bench, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side (in bytes, measured on the materialised data) that is shipped to every task.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rowtide") -> SparkSession:
    """Local session used by tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system path). Only a local-mode session
    without it (tests) gets a fresh folder under /tmp.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a classic SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and sc is not None:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="rowtide-ckpt-")
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint directory (shared storage on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPES = threading.local()  # a stream's micro-batches run in threads of their own


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove, at the end of the block, the tables that :func:`materialize` wrote inside it (one micro-batch)."""
    outer, _SCOPES.paths = getattr(_SCOPES, "paths", None), []
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _SCOPES.paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        _SCOPES.paths = outer


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job; the result's plan is a file scan (lineage cut, small plans downstream), its data
    survives executor loss, and readers get column pruning and filter pushdown on it. Used for the
    folded effects, measured broadcast sides, and between iterations / micro-batches.
    """
    path = scratch_path(df.sparkSession, "table")
    if getattr(_SCOPES, "paths", None) is not None:
        _SCOPES.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    parts: list[Column] = [F.lit(16)]
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def measured_bytes(df: DataFrame) -> int:
    """Exact payload size of a (materialised) DataFrame: one aggregate job."""
    return int(df.select(F.sum(_row_bytes(df).cast("long"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its measured size is at most ``max_bytes``.

    ``df`` is materialised (written once to the shared checkpoint folder, read back as a file scan)
    and measured with one aggregate job over that table. Beyond the bound the plain DataFrame is returned and Spark
    plans a shuffle join.
    """
    df = materialize(df)
    if measured_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df

"""Change capture: row images from two snapshots, packets per event kind, routing by a registry.

The database row trigger of the reference becomes a set-based diff: a full outer join of the old and
new snapshot on the key. A key change shows as delete + insert; a no-op update is not seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.contract import TableContract
from rowtide.functions.packets import map_of, packet_struct
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small, materialize


def capture_diff(old: DataFrame, new: DataFrame, contract: TableContract, seq: Column | None = None) -> DataFrame:
    """Row images ``op`` (INSERT/UPDATE/DELETE), ``old`` and ``new`` row structs, and ``seq``.

    ``seq`` defaults to the key if it is one integer column, else to its place in key order (each key changes
    once in a diff, so any unique order is valid).
    """
    key = list(contract.primary_key)
    o = old.select(*[F.col(c).alias(f"__o_{c}") for c in contract.names], F.lit(True).alias("__in_old"))
    n = new.select(*[F.col(c).alias(f"__n_{c}") for c in contract.names], F.lit(True).alias("__in_new"))
    j = o.join(n, [F.col(f"__o_{k}") == F.col(f"__n_{k}") for k in key], "full_outer")
    changed = reduce(
        lambda a, b: a | b, [~F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}")) for c in contract.non_key], F.lit(False)
    )
    op = (
        F.when(F.col("__in_old").isNull(), "INSERT")
        .when(F.col("__in_new").isNull(), "DELETE")
        .when(changed, "UPDATE")
    )
    old_row = F.when(F.col("__in_old"), F.struct(*[F.col(f"__o_{c}").alias(c) for c in contract.names]))
    new_row = F.when(F.col("__in_new"), F.struct(*[F.col(f"__n_{c}").alias(c) for c in contract.names]))
    images = j.select(op.alias("op"), old_row.alias("old"), new_row.alias("new")).where(F.col("op").isNotNull())
    if seq is None:
        first = F.coalesce(F.col(f"new.{key[0]}"), F.col(f"old.{key[0]}"))
        if len(key) == 1 and isinstance(contract.spark_type(key[0]), (T.ShortType, T.IntegerType, T.LongType)):
            seq = first.cast("bigint")
        else:  # any other key: numbered in key order, by sorted partitions; written, so that every reader sees the same numbers
            order = [F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}")) for k in key]
            return materialize(images.orderBy(*order).withColumn("seq", F.monotonically_increasing_id()))
    return images.withColumn("seq", seq)


def _row_map(row: str, columns: list[str]) -> Column:
    return map_of({c: F.col(f"{row}.{c}") for c in columns})


def capture_inserts(images: DataFrame, contract: TableContract) -> DataFrame:
    """INSERT -> ``add`` with the whole new row as data (NULLs kept as explicit nulls)."""
    return images.where(F.col("op") == "INSERT").select(
        packet_struct(F.col("seq"), F.lit("add"), _row_map("new", contract.names), None).alias("p")
    ).select("p.*")


def capture_deletes(images: DataFrame, contract: TableContract) -> DataFrame:
    """DELETE -> ``delete`` restricted by the old key values."""
    return images.where(F.col("op") == "DELETE").select(
        packet_struct(F.col("seq"), F.lit("delete"), None, _row_map("old", list(contract.primary_key))).alias("p")
    ).select("p.*")


def capture_updates(images: DataFrame, contract: TableContract) -> DataFrame:
    """UPDATE -> ``update``: restriction = old key, data = whole new row (so a key change is expressible)."""
    return images.where(F.col("op") == "UPDATE").select(
        packet_struct(
            F.col("seq"), F.lit("update"), _row_map("new", contract.names), _row_map("old", list(contract.primary_key))
        ).alias("p")
    ).select("p.*")


def capture_changes(images: DataFrame, contract: TableContract) -> DataFrame:
    return capture_inserts(images, contract).unionByName(capture_deletes(images, contract)).unionByName(
        capture_updates(images, contract)
    )


def route_changes(
    images: DataFrame, registry: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """Tag captured changes of many tables with their queue and key list from the capture registry.

    ``images`` carries ``schema_name, table_name``; ``registry`` has ``schema_name, table_name,
    queue_name, primary_key`` (JSON list). A missing queue name defaults to ``schema.table``; a
    table without a registry row is kept with ``reason = 'missing_registry'`` (quarantine) instead of
    failing the whole batch.
    """
    reg = registry.select(
        "schema_name", "table_name",
        F.concat(F.lit("/queue/"), F.coalesce(F.col("queue_name"), F.concat_ws(".", "schema_name", "table_name"))).alias("queue"),
        F.from_json("primary_key", "array<string>").alias("key_columns"),
        F.lit(True).alias("__registered"),
    )
    reg = broadcast_if_small(reg, broadcast_bytes) if broadcast_bytes > 0 else reg
    out = images.join(reg, ["schema_name", "table_name"], "left")
    return out.withColumn("reason", F.when(F.col("__registered").isNull(), "missing_registry")).drop("__registered")

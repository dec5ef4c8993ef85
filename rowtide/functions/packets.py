"""Packet envelope and the per-column expressions that project packets onto a table contract.

Wire form (one JSON object per packet)::

    {"seq": 17, "action": "set", "data": {"col": "value", ...}, "restriction": {"col": "value", ...}}

``data`` / ``restriction`` are MAP<STRING,STRING>, not structs: a column that is absent must stay
distinguishable from a column explicitly sent as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract

ENVELOPE_DDL = "seq BIGINT, action STRING, data MAP<STRING,STRING>, restriction MAP<STRING,STRING>"
ACTIONS = ("add", "set", "update", "delete")

# JSON writer options: keep explicit nulls, keep microseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Column names of the aligned (wide) packet form.
def dv(c: str) -> str:
    """typed value of ``c`` in ``data``"""
    return f"d__{c}"


def dp(c: str) -> str:
    """``c`` present in ``data`` (even if null)"""
    return f"dp__{c}"


def rv(c: str) -> str:
    """typed value of ``c`` in ``restriction``"""
    return f"r__{c}"


def rp(c: str) -> str:
    """``c`` present in ``restriction``"""
    return f"rp__{c}"


def has(map_col: str, key: str) -> Column:
    return F.coalesce(F.map_contains_key(F.col(map_col), F.lit(key)), F.lit(False))


def raw(map_col: str, key: str) -> Column:
    return F.col(map_col).getItem(key)


def typed(map_col: str, key: str, ddl: str) -> Column:
    """Value cast to the contract type; a failed cast is NULL (flagged as bad_value by validation)."""
    return raw(map_col, key).try_cast(ddl)


def unknown_keys(map_col: str, contract: TableContract) -> Column:
    """Map keys that are not columns of the table (dropped by alignment)."""
    known = F.array(*[F.lit(c) for c in contract.names])
    return F.coalesce(F.array_except(F.map_keys(F.col(map_col)), known), F.array().cast("array<string>"))


def extra_entries(map_col: str, contract: TableContract) -> Column:
    """The map's entries of unknown columns; NULL without any."""
    rest = F.map_filter(F.col(map_col), lambda k, v: ~k.isin(contract.names))
    return F.when(F.size(unknown_keys(map_col, contract)) > 0, rest)


def with_extra(known: Column, extra: str) -> Column:
    """A map of known columns and the entries that came with them."""
    return F.when(F.col(extra).isNull(), known).otherwise(F.map_concat(known, F.col(extra)))


def to_text(c: Column) -> Column:
    """A typed value as packet text; timestamps keep microseconds."""
    return c.cast("string")


def packet_struct(seq: Column, action: Column, data: Column | None, restriction: Column | None) -> Column:
    null_map = F.lit(None).cast("map<string,string>")
    return F.struct(
        seq.cast("bigint").alias("seq"),
        action.alias("action"),
        (data if data is not None else null_map).alias("data"),
        (restriction if restriction is not None else null_map).alias("restriction"),
    )


def map_of(columns: dict[str, Column], presence: dict[str, Column] | None = None) -> Column:
    """MAP<STRING,STRING> from named values; a column whose presence flag is false is left out.

    Built with ``map_concat`` of conditional one-entry maps: no lambda, so it stays in codegen.
    """
    empty = F.create_map().cast("map<string,string>")
    parts = []
    for name, value in columns.items():
        entry = F.create_map(F.lit(name), to_text(value))
        flag = (presence or {}).get(name)
        parts.append(entry if flag is None else F.when(flag, entry).otherwise(empty))
    return F.map_concat(*parts) if len(parts) > 1 else parts[0]


# ---------------------------------------------------------------- client verbs (build packets from a frame)
def packets_add(df: DataFrame, seq: Column, columns: list[str] | None = None) -> DataFrame:
    """``add`` per row, data = the given (default: all) columns."""
    cols = columns or df.columns
    return df.select(packet_struct(seq, F.lit("add"), map_of({c: F.col(c) for c in cols}), None).alias("p")).select("p.*")


def packets_upsert(df: DataFrame, seq: Column, columns: list[str] | None = None) -> DataFrame:
    """``set`` (insert or update) per row."""
    cols = columns or df.columns
    return df.select(packet_struct(seq, F.lit("set"), map_of({c: F.col(c) for c in cols}), None).alias("p")).select("p.*")


def packets_update(df: DataFrame, seq: Column, key: list[str], columns: list[str]) -> DataFrame:
    """``update`` per row: restriction = key columns, data = ``columns``."""
    return df.select(
        packet_struct(seq, F.lit("update"), map_of({c: F.col(c) for c in columns}), map_of({k: F.col(k) for k in key})).alias("p")
    ).select("p.*")


def packets_delete(df: DataFrame, seq: Column, key: list[str]) -> DataFrame:
    """``delete`` per row restricted by the key columns."""
    return df.select(packet_struct(seq, F.lit("delete"), None, map_of({k: F.col(k) for k in key})).alias("p")).select("p.*")

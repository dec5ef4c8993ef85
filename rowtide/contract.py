"""Declared table contract: the schema and constraints a change log is checked and applied against."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SIMPLE_TYPES = {
    "smallint": T.ShortType(), "int": T.IntegerType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "float": T.FloatType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def ddl_type(ddl: str) -> T.DataType:
    """Spark type for a simple DDL type name (``decimal(p,s)`` included)."""
    ddl = ddl.strip().lower()
    if ddl in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[ddl]
    if ddl.startswith("decimal"):
        p, s = ddl[ddl.index("(") + 1 : ddl.index(")")].split(",")
        return T.DecimalType(int(p), int(s))
    raise ValueError(f"unsupported column type {ddl!r}")


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of this table reference ``parent_columns`` of a parent table."""

    columns: tuple[str, ...]
    parent_columns: tuple[str, ...]
    name: str = "fk"


@dataclass(frozen=True)
class TableContract:
    """Schema plus keys, defaults and constraints of a table.

    ``columns``      (name, Spark DDL type) in table order.
    ``primary_key``  key columns; implicitly NOT NULL.
    ``unique_keys``  further unique column sets, in order of preference.
    ``required``     NOT NULL columns without a default (besides the key).
    ``defaults``     column -> Python literal, or a Column over the packet row
                     (e.g. ``F.col("ts")`` for a ``now()`` taken from the packet).
    ``surrogate``    key column the engine allocates for keyless inserts.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    primary_key: tuple[str, ...]
    unique_keys: tuple[tuple[str, ...], ...] = ()
    required: frozenset[str] = frozenset()
    defaults: dict[str, Any] = field(default_factory=dict)
    surrogate: str | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __hash__(self) -> int:  # defaults may hold Columns; identity is enough
        return id(self)

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def non_key(self) -> list[str]:
        return [c for c in self.names if c not in self.primary_key]

    def type_of(self, column: str) -> str:
        return dict(self.columns)[column]

    def spark_type(self, column: str) -> T.DataType:
        return ddl_type(self.type_of(column))

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.spark_type(c), c not in self.primary_key) for c in self.names])

    def is_required(self, column: str) -> bool:
        return column in self.primary_key or (column in self.required and column not in self.defaults)

    def default(self, column: str) -> Column:
        """Default value for ``column`` on insert, typed; NULL when none is declared."""
        if column in self.defaults:
            d = self.defaults[column]
            expr = d if isinstance(d, Column) else F.lit(d)
        else:
            expr = F.lit(None)
        return expr.cast(self.type_of(column))

    def has_computed_default(self, column: str) -> bool:
        return isinstance(self.defaults.get(column), Column)

    def qualified(self) -> str:
        """``schema.table``; a bare name lives in ``public``."""
        return self.name if "." in self.name else f"public.{self.name}"

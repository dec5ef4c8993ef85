"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
NON_WHITE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs without white space."""
    return F.filter(F.split(text, WHITE, -1), lambda w: w != F.lit(""))


def row_key(*columns: str) -> Column:
    """64 bits that equal rows share; used together with the row's id, so that rows with one id stay apart."""
    return F.xxhash64(*[F.col(c) for c in columns])


def quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def join_rows(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> tuple[DataFrame, dict[str, str]]:
    """Join ``found(doc_id, _key, ...)`` to the rows of ``docs`` with that id and text; the new names of its columns."""
    names = {c: fresh(f"_found_{c}", docs.columns) for c in found.columns}
    key = fresh("_row_key", docs.columns)
    renamed = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    return keyed.join(renamed, F.col(id_col).eqNullSafe(F.col(names["doc_id"])) & (F.col(key) == F.col(names["_key"])), how), names


def release_memory() -> None:
    """Give memory that a task has freed back to the system: workers stay, beside the JVM, when their stage is over."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, with :func:`release_memory` at the end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return wrapped

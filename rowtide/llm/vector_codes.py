"""Vector code compression with per-dimension value dictionaries.

Components become integers floor(scale * x). Vectors are cut into ``parts`` equal runs of components, each part position
has a codebook of at most ``entries`` integer entries, and a vector is stored as one entry number per part.

1. A task takes a batch of vectors and, per dimension, the dictionary of its distinct integers. The squared differences
   of every distinct integer to that component of all entries are tabulated once. The distances of a part are then sums
   of table rows, gathered by the vectors' dictionary codes; the smallest, at the lowest index, is the part's entry.
2. A round sums the components per (part, entry) inside the tasks, and Spark adds up these partial sums: as many rows as
   the codebooks have numbers, per task. The new codebooks (parts * entries * part width integers, whatever the table's
   size) come to the driver and go out with the next pass.
3. The last pass writes codes and errors once; errors are summed by label and joined back. The label sums are
   broadcast only if they are measured to be small.

Edge cases: vectors that are null, or hold null or non-finite components (before or after scaling), are dropped;
integers saturate at 2^26, so that no 64-bit sum overflows; a vector shorter than the longest, or a length that isn't a
multiple of ``parts``, is filled up with zeros; a null id comes last among the first entries and keeps its row; of equal
ids the smaller vector is the earlier entry; equal rows get equal codes; null labels are summed together; only the three
given columns are read, so further columns, whatever their names, don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import broadcast_if_small, materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 26
BATCH = 4096

Codebooks = np.ndarray  # (parts, entries, width of a part) of int64


def integers(vector: Column, scale: int = SCALE) -> Column:
    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")

    return F.transform(vector, whole)


def usable(vector: Column, scale: int = SCALE) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(F.lit(float(scale)) * x.cast("double")) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def value_dictionary(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct integers, ascending, and the code of every row."""
    low, high = int(column.min()), int(column.max())
    if high - low > 8 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    present = np.zeros(high - low + 1, bool)
    present[column - low] = True
    return np.flatnonzero(present) + low, (np.cumsum(present) - 1)[column - low]


def assign(vectors: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: two arrays (rows, parts)."""
    parts, _, width = books.shape
    entry, error = np.zeros((len(vectors), parts), np.int64), np.zeros((len(vectors), parts), np.int64)
    for part in range(parts):
        total = None
        for i in range(width):
            values, codes = value_dictionary(vectors[:, part * width + i])
            table = (values[:, None] - books[part, :, i][None, :]) ** 2
            gathered = table[codes]
            total = gathered if total is None else np.add(total, gathered, out=total)
        if total is not None:
            entry[:, part] = total.argmin(1)  # the first of equal distances
            error[:, part] = total[np.arange(len(total)), entry[:, part]]
    return entry, error


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an array (rows, width), short rows filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _sums(books: Codebooks) -> Callable:
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                vectors = _matrix(batch.column(0).slice(start, BATCH), parts * width)
                entry, _ = assign(vectors, books)
                for part in range(parts):
                    counts[part] += np.bincount(entry[:, part], minlength=entries)
                    np.add.at(sums[part], entry[:, part], vectors[:, part * width : (part + 1) * width])
        part, number = np.nonzero(counts)
        names = ["part", "entry", "sums", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(number, pa.int32()), pa.array(list(sums[part, number]), pa.list_(pa.int64())), pa.array(counts[part, number], pa.int64())], names=names)

    return run


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one round over all rows: entries become the floored means of their parts."""
    parts, _, width = books.shape
    partial = rows.select("v").mapInArrow(_sums(books), "part int, entry int, sums array<long>, n long")
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():  # at most parts * entries rows
        out[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def _codes(books: Codebooks) -> Callable:
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                entry, error = assign(_matrix(part.column(2), parts * width), books)
                digits = entry.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes, pa.string()), pa.array(error.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def first_books(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the ``entries`` smallest ids."""
    width = -(-(rows.agg(F.max(F.size("v"))).first()[0] or 0) // parts)
    first = [r["v"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()]  # a codebook
    books = np.zeros((parts, len(first), width), np.int64)
    for k, v in enumerate(first):
        books[:, k, :] = np.array([*v, *[0] * (parts * width - len(v))], np.int64).reshape(parts, width)
    return books


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of every usable vector, written once, and the final codebooks. At most 256 entries."""
    rows = vectors.where(usable(F.col(vector_col), scale)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), integers(F.col(vector_col), scale).alias("v"))
    rows = materialize(rows)
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = improved(rows, books)
    kind = rows.schema["label"].dataType.simpleString()
    return materialize(rows.select("vec_id", "label", "v").mapInArrow(_codes(books), f"vec_id long, label {kind}, code string, error long")), books


def decompress(coded: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``v``: the entries that the code names, in a row."""
    numbers = F.transform(F.sequence(F.lit(0), F.lit(books.shape[0] - 1)), lambda i: F.conv(F.substring("code", 2 * i + 1, F.lit(2)), 16, 10).cast("int"))
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in part]) for part in books])
    picked = F.zip_with(table, numbers, lambda part, k: F.get(part, k))
    return coded.withColumn("v", F.flatten(picked))


def report(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per usable vector."""
    coded, books = compress(vectors, **options)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    joined = coded.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


_ASSIGN = """
{name} AS (
  SELECT r, p.part, min(list_sum(list_transform(list_zip(p.s, b.s), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.entry) AS best
  FROM p JOIN {books} b ON b.part = p.part GROUP BY r, p.part
)"""
_IMPROVE = """
{name}_sums AS (
  SELECT a.part, a.best % 64 AS entry, g.i, sum(p.s[g.i])::HUGEINT AS total, count(*)::HUGEINT AS n
  FROM {found} a JOIN p ON p.r = a.r AND p.part = a.part, (SELECT unnest(range(1, 1 + (SELECT max(len(s)) FROM p))) AS i) g GROUP BY ALL
), {name}_means AS (
  SELECT part, entry, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY i) AS s FROM {name}_sums GROUP BY part, entry
), {name} AS (
  SELECT b.part, b.entry, coalesce(m.s, b.s) AS s FROM {books} b LEFT JOIN {name}_means m ON m.part = b.part AND m.entry = b.entry
)"""
ORACLE_SQL = (
    """
WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT r, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS s FROM k, (SELECT unnest(range(16)) AS part) t
), first AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM k),
b0 AS (SELECT p.part, f.entry, p.s FROM p JOIN first f ON f.r = p.r WHERE f.entry < 64),"""
    + _ASSIGN.format(name="a0", books="b0") + "," + _IMPROVE.format(name="b1", found="a0", books="b0") + ","
    + _ASSIGN.format(name="a1", books="b1") + "," + _IMPROVE.format(name="b2", found="a1", books="b1") + ","
    + _ASSIGN.format(name="a2", books="b2")
    + """,
c AS (SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY r),
d AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, entry)) AS h FROM b2)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, d.h AS codebooks_sha256
FROM c JOIN k ON k.r = c.r, d
"""
)

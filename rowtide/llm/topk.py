"""Exact top-k search by Fagin's threshold algorithm.

Vectors are cut into blocks of at most ``BLOCK`` rows. A block keeps, per dimension, its rows sorted by that
component. A query reads these lists in step, from the top for positive and from the bottom for negative query
components, scores every row it meets by random access, and stops when its k-th score is above the bound: the score that
a row not met so far could still reach, from the components at the current depth of all lists. The depth doubles from
step to step. Each block gives its k best; a rank over these few rows gives the answer.

Blocks of queries meet blocks of candidates by a join on the candidate block, so every task holds one block of each.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part; vectors meet only
vectors of their own length; rows that share an id are candidates each, but not of queries with that id, and queries each if
their vectors differ; a null id is a candidate of no query and no query itself; components saturate at 2^26 after scaling,
so that scores of up to 2,048 dimensions don't overflow; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import materialize

BLOCK = 8192
QUERY_BLOCK = 512
SCALE = 256
LIMIT = 1 << 26


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a double."""
    top = F.lit(float(LIMIT))
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), top), -top)))


class Lists:
    """Sorted lists per dimension over the rows of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.falling = np.argsort(-self.vectors, axis=0, kind="stable")

    def search(self, query: np.ndarray, own: int, k: int, depth: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``: larger score first, then smaller id."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        sign = query[used] > 0
        met = np.zeros(n, bool)
        best_id, best = np.empty(0, np.int64), np.empty(0, np.int64)
        start = 0
        while start < n:
            end = min(n, max(depth, 2 * start)) if len(used) else n
            fresh = np.full(n, not len(used))  # a query of zeros has no lists
            fresh[self.falling[start:end][:, used[sign]]] = True
            fresh[self.falling[n - end : n - start][:, used[~sign]]] = True
            rows = np.flatnonzero(fresh & ~met)
            met[rows] = True
            rows = rows[self.ids[rows] != own]
            ids, scores = np.r_[best_id, self.ids[rows]], np.r_[best, self.vectors[rows] @ query]
            if len(ids) > 4 * k:
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                ids, scores = ids[scores >= cut], scores[scores >= cut]
            top = np.lexsort((ids, -scores))[:k]
            best_id, best = ids[top], scores[top]
            if met.all():
                break
            if end < n and len(best) == k:
                edge = np.where(sign, self.vectors[self.falling[end - 1, used], used], self.vectors[self.falling[n - end, used], used])
                if best[-1] > int(edge @ query[used]):
                    break
            start = end
        return best_id, best


def _unpack(blob: bytes, count: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(count, -1)


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per block: its ids and vectors as bytes."""
    frame = frame.sort_values("vec_id")
    vectors = np.array(frame["v"].tolist(), np.int64)
    return pd.DataFrame([(int(frame["dim"].iloc[0]), int(frame["block"].iloc[0]), len(frame), frame["vec_id"].to_numpy(np.int64).tobytes(), vectors.tobytes())], columns=["dim", "block", "count", "ids", "vectors"])


_PACKED = "dim int, block long, count int, ids binary, vectors binary"


def _search_map(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, lists = None, None
        for frame in frames:
            for row in frame.itertuples(index=False):
                if held != (row.dim, row.block):
                    held, lists = (row.dim, row.block), Lists(np.frombuffer(row.ids, np.int64), _unpack(row.vectors, row.count))
                out = []
                queries = _unpack(row.q_vectors, row.q_count)
                for query_id, query in zip(np.frombuffer(row.q_ids, np.int64).tolist(), queries, strict=True):
                    ids, scores = lists.search(query, query_id, k)
                    which = int.from_bytes(hashlib.blake2b(query.tobytes(), digest_size=8).digest(), "little", signed=True)
                    out += [(query_id, which, i, s) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
                yield pd.DataFrame(out, columns=["query_id", "which", "vec_id", "score"], dtype="int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of every query with all other rows."""
    fine = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.coalesce(fine, F.lit(False)) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    rows = materialize(rows.withColumn("dim", F.size("v")))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("q").alias("nq"))  # rows, ids may repeat
    blocks = rows.join(F.broadcast(sizes), "dim")  # a row per vector length
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("n") / BLOCK)))
    candidates = blocks.groupBy("dim", "block").applyInPandas(_pack, _PACKED)
    asked = blocks.filter("q").dropDuplicates(["vec_id", "v"]).withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("nq") / QUERY_BLOCK)))
    queries = asked.groupBy("dim", "block").applyInPandas(_pack, _PACKED)
    queries = queries.select("dim", F.col("count").alias("q_count"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")).join(F.broadcast(sizes), "dim")
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1))).drop("n", "nq")
    met = sent.join(candidates, ["dim", "block"]).select("dim", "block", "count", "ids", "vectors", "q_count", "q_ids", "q_vectors")
    found = met.mapInPandas(_search_map(k), "query_id long, which long, vec_id long, score long")
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

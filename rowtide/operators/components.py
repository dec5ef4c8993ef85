"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import materialize


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links of a batch by links from every node to the smallest node it reaches in the batch."""
    for frame in frames:
        root: dict[int, int] = {}

        def find(x: int, root: dict[int, int] = root) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for u, v in zip(frame["u"].tolist(), frame["v"].tolist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in list(root)]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"], dtype="int64")


def _settled(edges: DataFrame) -> bool:
    """Does every node link to one smaller node that links to none? Then a step would change nothing."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where((F.col("out") > 1) | (F.col("out") > 0) & (F.col("into") > 0)).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(u, v)``; the label is the smallest node of its component.

    Every step groups by a node with partial aggregation and joins the minima back, so a node with very many
    neighbours is never held in memory. The edges are written to the shared folder once per step; the loop ends when
    a step would change nothing. Links with a null end or to itself say nothing. No links: an empty result.
    """
    edges = links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(edges.mapInPandas(_contract, "u long, v long").distinct())
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter(F.col("u") != F.col("v"))
        edges = materialize(small.distinct())
    label = edges.groupBy("u").agg(F.min("v").alias("label"))
    return label.select(F.col("u").alias("node"), "label").unionByName(label.select(F.col("label").alias("node"), "label").distinct())

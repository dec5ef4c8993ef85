"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is binned by quantiles of the training rows. Cyclic boosting visits the features in turn; each visit fits
a shallow tree (up to four leaves) on that one feature to the gradient of the log loss and adds a small step of it to
the feature's lookup table. Then the pairs of features whose coarse grid explains most of the remaining gradient are
boosted in the same way with trees that split both features. A score is the sigmoid of the sum of table entries.

Features come from the text alone, by built-in functions. The model is fitted on a bounded sample of the labelled rows
(``max_rows``, the smallest hashes of the ids); everything else runs over all documents.

Edge cases: null text is empty and scored like any other; null labels and labels without a document are left out; of
several labels of one id the largest counts; without labels of both classes the score is the smoothed share of label 1
for every document; equal rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import NON_WHITE, join_rows, quoted, row_key, words_of
from rowtide.session import broadcast_if_small

MAX_ROWS = 20_000
THRESHOLD = 0.7
BINS = 32
COARSE = 8


def features(docs: DataFrame, *keep: Column, text_col: str = "text") -> DataFrame:
    """``keep`` and ``x``: the features of each text as an array of doubles."""
    a = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    names = [c for c in a.columns if c != "_t"]
    b = a.withColumns({"_w": words_of(F.col("_t")), "_l": F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(NON_WHITE)), "_n": F.greatest(F.length("_t"), F.lit(1))})

    def share(chars: str) -> Column:
        return (F.length("_t") - F.length(F.translate("_t", chars, ""))) / F.col("_n")

    words = F.greatest(F.size("_w"), F.lit(1))
    same = F.size(F.filter(F.zip_with("_w", F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))), lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    x = [
        F.log1p(F.size("_w")),
        F.length(F.translate("_t", " \t\n\x0b\x0c\r", "")) / words,
        share("#*$%&|<>~^@=+_{}[]\\"),
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        share("!?"),
        share("0123456789"),
        share("|"),
        share("."),
        share(","),
        same / words,
        F.size(F.array_distinct("_w")) / words,
        F.log1p(F.size("_w")) * F.size(F.array_distinct("_w")) / words,
        F.size(F.filter("_w", lambda w: F.length(w) <= 3)) / words,
        F.log1p(words / F.greatest(F.size("_l"), F.lit(1))),
        (F.size("_l") - F.size(F.array_distinct("_l"))) / F.greatest(F.size("_l"), F.lit(1)),
    ]
    return b.select(*names, F.array(*[v.cast("double") for v in x]).alias("x"))


@dataclass
class Model:
    """Lookup tables over bins: one per feature, one per chosen pair on a coarser grid."""

    intercept: float
    edges: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if len(self.edges) and len(x):
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                total += t[b[:, j]]
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                total += t[b[:, i] * COARSE // BINS, b[:, j] * COARSE // BINS]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins with gradient and hessian sums; place 0: none."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
    k = int(np.argmax(gain))
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree with up to 2**depth leaves."""
    _, at = _best_cut(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree that cuts the rows of a grid once, where this and a cut of each side's columns gain most, and the
    columns of each side up to twice."""
    parts, best = [(0, len(g))], _best_cut(g.sum(0), h.sum(0))[0]
    for at in range(1, len(g)):
        sides = [(g[:at].sum(0), h[:at].sum(0)), (g[at:].sum(0), h[at:].sum(0))]
        gain = sum(a.sum() ** 2 / (b.sum() + 1) + _best_cut(a, b)[0] for a, b in sides) - g.sum() ** 2 / (h.sum() + 1)
        if gain > best + 1e-9:
            parts, best = [(0, at), (at, len(g))], gain
    out = np.zeros_like(g)
    for lo, hi in parts:
        out[lo:hi] = _tree(g[lo:hi].sum(0), h[lo:hi].sum(0), 2)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 5, rate: float = 0.15) -> Model:
    """Boost on features ``x`` and labels ``y`` (0 or 1)."""
    n1 = float(y.sum())
    prior = (n1 + 1) / (len(y) + 2)
    model = Model(float(np.log(prior / (1 - prior))), [], np.zeros((0, BINS)), [], np.zeros((0, COARSE, COARSE)))
    if not 0 < n1 < len(y):
        return model
    f = x.shape[1]
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    model.tables = np.zeros((f, BINS))
    b = model.bins(x)
    total = np.full(len(y), model.intercept)

    def step() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(f):
            g, h = step()
            change = rate * np.clip(_tree(np.bincount(b[:, j], g, BINS), np.bincount(b[:, j], h, BINS)), -4, 4)
            model.tables[j] += change
            total += change[b[:, j]]
    c = b * COARSE // BINS
    g, h = step()
    gains = []
    for i in range(f):
        for j in range(i):
            cell = c[:, i] * COARSE + c[:, j]
            a, d = np.bincount(cell, g, COARSE**2), np.bincount(cell, h, COARSE**2)
            gains.append((float((a**2 / (d + 1)).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    model.pair_tables = np.zeros((len(model.pairs), COARSE, COARSE))
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = step()
            cell = c[:, i] * COARSE + c[:, j]
            shape = (COARSE, COARSE)
            change = rate * np.clip(_grid_tree(np.bincount(cell, g, COARSE**2).reshape(shape), np.bincount(cell, h, COARSE**2).reshape(shape)), -4, 4)
            model.pair_tables[k] += change
            total += change.ravel()[cell]
    return model


def _matrix(x: pd.Series) -> np.ndarray:
    return np.array(x.tolist(), float) if len(x) else np.zeros((0, 1))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents that aren't held out."""
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label_col).alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)  # bounded: max_rows ids and labels
    used = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    rows = features(used, F.col("_id"), F.col("_y"), text_col="_text").orderBy("_id", "x").limit(2 * max_rows).toPandas()  # twice: ids may repeat
    return fit(_matrix(rows["x"]), rows["_y"].to_numpy(float))


def score_documents(docs: DataFrame, model: Model, *keep: Column, text_col: str = "text") -> DataFrame:
    """``keep`` and ``score`` for every document."""
    rows = features(docs, *keep, text_col=text_col)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(x)))

    return rows.withColumn("score", scored("x")).drop("x")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, _key, held_out, score, predicted`` for every document."""
    model = train(docs, labels, id_col, text_col, max_rows=max_rows)
    scored = score_documents(docs, model, F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("_key"), text_col=text_col)
    return scored.select("doc_id", "_key", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the classifier predicts as good, with all their columns."""
    bad = classify(docs, labels, id_col, text_col, **options).filter("predicted = 0").select("doc_id", "_key").distinct()
    return join_rows(docs, broadcast_if_small(bad), id_col, text_col, "left_anti")[0].select(*quoted(docs.columns))

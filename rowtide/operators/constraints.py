"""Referential constraints as joins: parent delete RESTRICT, parent key change CASCADE.

Insert-side foreign key checks (X3) live in ``apply.fk_violations`` because they decide the fold class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.contract import ForeignKey


def check_restrict(parent_deletes: DataFrame, child: DataFrame, fk: ForeignKey) -> DataFrame:
    """ON DELETE RESTRICT: a parent delete whose key still has child rows is refused.

    ``parent_deletes`` holds the deleted parent keys (``fk.parent_columns``) and ``seq``. Output adds
    ``outcome`` = 'refused' (semi join hit) or 'deleted'. The child side is reduced to its distinct
    foreign key values first (partial aggregation), so a parent with millions of children costs one row.
    """
    refs = child.select(*[F.col(c).alias(p) for c, p in zip(fk.columns, fk.parent_columns)]).distinct().withColumn("__ref", F.lit(True))
    j = parent_deletes.join(refs, list(fk.parent_columns), "left")
    return j.withColumn("outcome", F.when(F.col("__ref"), "refused").otherwise("deleted")).drop("__ref")


def cascade_update(child: DataFrame, moves: DataFrame, fk: ForeignKey) -> DataFrame:
    """ON UPDATE CASCADE: rewrite child foreign keys by parent key moves (``old_<p>``, ``new_<p>`` per parent column)."""
    cond = [F.col(c) == F.col(f"old_{p}") for c, p in zip(fk.columns, fk.parent_columns)]
    j = child.join(moves, cond, "left")
    out = [
        F.coalesce(F.col(f"new_{p}"), F.col(c)).cast(child.schema[c].dataType).alias(c) if c in fk.columns else F.col(c)
        for c in child.columns
        for p in [dict(zip(fk.columns, fk.parent_columns)).get(c)]
    ]
    return j.select(*out)


def quarantine(outcomes: DataFrame) -> DataFrame:
    """Packets set aside instead of halting the worker (``on_error='quarantine'``)."""
    return outcomes.where(F.col("outcome") == "quarantined")

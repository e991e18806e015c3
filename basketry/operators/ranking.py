"""Ordering helpers: top-k (exact n) and top-k with ties.

Every limit carries a tie-break key so results do not change between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: str, tie_key: str, n: int) -> DataFrame:
    """Exactly n rows, largest ``by`` first, ties broken by ``tie_key``.
    Plans as TakeOrderedAndProject: each task keeps n rows, one merge."""
    return df.orderBy(F.desc(by), F.asc(tie_key)).limit(n)


def top_n_with_ties(df: DataFrame, by: str, n: int, name: str = "rank") -> DataFrame:
    """All rows whose dense rank by ``by`` (largest first, NULL last) is <= n;
    ties may give more than n rows (O5).

    Same result as a global ``dense_rank() <= n`` without its single-partition
    window: when many rows share the top values, that window would still
    send them all to one task. Here the n largest distinct values are found
    with a distinct + top-n (at most n rows leave each task), numbered in a
    window over those n rows, and broadcast (a proven bound of n rows) into
    a join that keeps every row holding one of them, in parallel."""
    values = df.select(by).distinct()
    top = values.orderBy(F.desc_nulls_last(by)).limit(n)
    ranked = top.select(F.col(by).alias("__v"),
                        F.row_number().over(Window.orderBy(F.desc_nulls_last(by))).cast("long").alias(name))
    return (df.join(F.broadcast(ranked), df[by].eqNullSafe(ranked["__v"]))
              .drop("__v"))

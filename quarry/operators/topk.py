"""SRT-4 / SRT-5: top-k reports.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition keeps a bounded heap
of k rows and only k rows per partition reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, col: str, k: int, tiebreak: str | None = None) -> DataFrame:
    """The k largest rows by ``col`` (k > n gives all, k = 0 none, k < 0 is an error).

    Rows are returned in ascending order, as the reference's sorter reports them; ties are
    broken by ``tiebreak`` ascending so the result is deterministic.
    """
    if k < 0:
        raise ValueError("k must be non-negative")
    order = [F.col(col).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    best = df.orderBy(*order).limit(k)
    back = [F.col(col).asc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    return best.orderBy(*back)


def top_k_per(df: DataFrame, keys: list[str], col: str, k: int, tiebreak: str | None = None,
              name: str = "pos") -> DataFrame:
    """k best per group, numbered 1..k from the best (partial WindowGroupLimit before the shuffle)."""
    from pyspark.sql import Window
    if k < 0:
        raise ValueError("k must be non-negative")
    order = [F.col(col).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def rounded_average(df: DataFrame, keys: list[str], col: str, name: str = "avg") -> DataFrame:
    """MTH-2: per-group mean rounded half-up to a whole number (not banker's rounding)."""
    return df.groupBy(*keys).agg(F.floor(F.avg(col) + 0.5).cast("long").alias(name))

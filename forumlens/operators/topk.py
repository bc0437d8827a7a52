"""Ordered top-k with an explicit rank column.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only those reach the final merge, so the single task
at the end sees at most ``k x tasks`` rows no matter how large the input is.
The rank is numbered over those k rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_top_k(df: DataFrame, order: Sequence[Column], k: int,
                 rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows under ``order`` plus ``rank`` = 1..k.

    ``order`` must be a total order over the rows for the result to be
    deterministic; callers add tie-breakers.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    top = df.orderBy(*order).limit(k)
    # The window sees only the <= k rows left after the limit.
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("int"))


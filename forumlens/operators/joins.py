"""Join helpers.

The analyses join after pre-aggregating wherever the semantics allow, so a
join side is usually one row per key.  Strategy choice is left to Spark:
adaptive execution measures the shuffled sides and switches to a broadcast
only when a side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and splits a skewed partition into several tasks (``skewJoin``).  An explicit
broadcast is used only for inputs with a bound known before execution
(``broadcast_bounded``) or counted first (``broadcast_if_few``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction.

    ``max_rows`` is the bound (e.g. of an already collected ``k``-row relation);
    a side that exceeds it is an error, rows are never dropped.
    """
    if max_rows > 1_000_000:
        raise ValueError("broadcast_bounded is for small, provably bounded sides")
    found = df.limit(max_rows + 1).count()
    if found > max_rows:
        raise ValueError(f"the side has more than the stated {max_rows} rows")
    return F.broadcast(df)


def broadcast_if_few(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """``df`` with a broadcast hint while it has at most ``max_rows`` short rows, which is
    counted first; larger sides are left to a shuffle join.  The rows are the same either way."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

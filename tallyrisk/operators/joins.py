"""Join helpers.

Dimension joins let Spark decide the strategy: the optimizer broadcasts a
side whose *estimated* size is under ``spark.sql.autoBroadcastJoinThreshold``
and AQE re-plans from the real shuffle size at run time; otherwise the join
is a sort-merge join, whose skewed partitions AQE splits as long as both sides
come straight from their exchanges (tests/test_skew.py).  ``join_dimension``
makes the broadcast explicit and checked: a hint is only added when the
optimizer's size estimate of the small side is known and under the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast bound, as Spark itself reads ``spark.sql.autoBroadcastJoinThreshold`` ("64MB", ...)."""
    n = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return max(n, 0)


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan, or None when it is not available."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """Join a fact table to a keyed dimension, broadcasting only a proven-small side.

    The bound defaults to the session's broadcast threshold; above it (or
    when the size is unknown) the join is shuffled on the key.
    """
    limit = broadcast_limit(fact) if max_broadcast_bytes is None else max_broadcast_bytes
    size = estimated_bytes(dim)
    if size is not None and 0 < limit and size <= limit:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


def left_join_fill(left: DataFrame, right: DataFrame, on, fills: dict[str, object]) -> DataFrame:
    """Left join a keyed aggregate and replace missing values (no match -> default)."""
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})

"""Size checks that come before a broadcast or a one-task step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` holds at most ``rows`` rows.

    A plain count: tasks send one number each, whereas a limit would move up to
    ``rows`` rows per task into a single one.
    """
    return df.count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after a count has proven the size.

    A larger side is returned as it is, and Spark joins it by shuffle, where AQE
    splits skewed partitions.
    """
    return F.broadcast(df) if at_most(df, rows) else df

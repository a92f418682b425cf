"""Joins against lookup tables, with the broadcast decided by a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def within(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, reading no more than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def sized(lookup: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``lookup`` marked for broadcast when it is proven small; otherwise unchanged.

    An unmarked side is shuffled, and adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(lookup) if within(lookup, rows) else lookup

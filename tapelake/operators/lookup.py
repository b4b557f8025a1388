"""Small dimension tables: broadcast them only when they are known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
"""About 100 MB of narrow rows (two keys, one value) in each executor."""


def is_small(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows; reads at most one more."""
    return lookup.limit(max_rows + 1).count() <= max_rows


def small_side(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``lookup`` marked for broadcast if it has at most ``max_rows`` rows, otherwise ``lookup`` unmarked.

    The check reads at most ``max_rows + 1`` rows. Unmarked, the join falls to the planner's own choice: sort-merge,
    where adaptive execution splits hot keys on the preserved (left) side.
    """
    return F.broadcast(lookup) if is_small(lookup, max_rows) else lookup

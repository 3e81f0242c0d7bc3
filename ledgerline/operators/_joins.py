"""Join helpers with an explicit size rule for broadcasting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped whole to every executor; above this many rows
# the join falls back to a shuffle join planned by Catalyst/AQE.
MAX_BROADCAST_ROWS = 2_000_000


def join_bounded(big: DataFrame, small: DataFrame, on: Column | list, how: str,
                 small_rows_bound: int | None,
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join, broadcasting ``small`` only when its row count is provably bounded.

    ``small_rows_bound`` is an upper bound the caller has proven (by
    construction or by a count); ``None`` means unknown, i.e. no broadcast.
    """
    if small_rows_bound is not None and small_rows_bound <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on, how)

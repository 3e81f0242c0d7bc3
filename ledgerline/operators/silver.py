"""Silver layer: rejoin the three feeds and enrich each transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    CORRUPT_TOLERANCE, EVENT_TIME_BASE, JITTER_RANGE_MICROS,
    event_time, hash_jitter_micros, is_corrupt)
from ledgerline.schemas import KEY, SILVER_COLUMNS, STEP


def join_feeds(transactions: DataFrame, accounts: DataFrame, fraud: DataFrame,
               on: Sequence[str] = (KEY, STEP)) -> DataFrame:
    """Inner-join the three feeds; the key columns appear once.

    ``on=("transaction_id", "step")`` keeps the source meaning that only feeds
    of the same batch are joined, and lets one job process many steps.
    ``on=("transaction_id",)`` matches across batches (the feeds' own ``step``
    columns are then dropped). Unmatched rows vanish and duplicate keys
    multiply, as in any inner join; :mod:`ledgerline.operators.quality` reports
    both. Strategy is Catalyst's/AQE's: a sort-merge join at scale, where the
    second join reuses the first one's key partitioning.
    """
    on = list(on)
    if STEP not in on:
        accounts = accounts.drop(STEP)
        fraud = fraud.drop(STEP)
    joined = transactions.join(accounts, on, "inner").join(fraud, on, "inner")
    return joined.select(*[c for c in SILVER_COLUMNS[:-2] if c in joined.columns])


def add_transaction_time(df: DataFrame, jitter: str = "hash", *,
                         base: str = EVENT_TIME_BASE, seed: int | None = None,
                         col: str = "transaction_time") -> DataFrame:
    """``transaction_time = base + step hours + jitter`` (``TIMESTAMP_NTZ``).

    ``jitter``: ``"hash"`` (default; stable offset from the transaction id),
    ``"none"`` (on the hour) or ``"random"`` (``rand(seed)``; differs between
    runs and layouts, kept only for parity with the original behaviour).
    """
    if jitter == "hash":
        j = hash_jitter_micros(KEY)
    elif jitter == "none":
        j = None
    elif jitter == "random":
        j = F.floor(F.rand(seed) * F.lit(JITTER_RANGE_MICROS)).cast("bigint")
    else:
        raise ValueError(f"unknown jitter mode {jitter!r}")
    return df.withColumn(col, event_time(STEP, j, base))


def add_is_corrupt(df: DataFrame, tol: float = CORRUPT_TOLERANCE,
                   col: str = "is_corrupt") -> DataFrame:
    """Flag rows whose origin balance does not add up; never drops them."""
    return df.withColumn(col, is_corrupt(tol))


def build_silver(transactions: DataFrame, accounts: DataFrame, fraud: DataFrame,
                 on: Sequence[str] = (KEY, STEP), jitter: str = "hash",
                 tol: float = CORRUPT_TOLERANCE) -> DataFrame:
    """Join + event time + quality flag: the 14-column silver table."""
    joined = join_feeds(transactions, accounts, fraud, on)
    return add_is_corrupt(add_transaction_time(joined, jitter), tol)

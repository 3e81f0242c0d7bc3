"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from ledgerline.functions.columns import (
    hash_jitter_micros,
    event_time,
    balance_error,
    is_corrupt,
    fraud_status,
    money,
    hour_of,
)

__all__ = [
    "hash_jitter_micros", "event_time", "balance_error", "is_corrupt",
    "fraud_status", "money", "hour_of",
]

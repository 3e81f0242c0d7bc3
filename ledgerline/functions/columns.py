"""Scalar column expressions shared by the operators.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen and can be pushed around freely by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source semantics.
EVENT_TIME_BASE = "2025-01-01 00:00:00"   # step 1 is 01:00 of this day
JITTER_RANGE_MICROS = 3_600_000_000       # spread events over the hour
CORRUPT_TOLERANCE = 0.01                  # strict '>' on the balance error
FRAUD_LABEL = "FRAUD"
LEGIT_LABEL = "LEGIT"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_jitter_micros(key: str | Column) -> Column:
    """Stable pseudo-random offset in ``[0, 1 h)`` derived from the key.

    First 48 bits of ``md5(key)`` modulo one hour in microseconds: spread like
    a uniform draw, but identical across retries, runs and data layouts.
    """
    hex12 = F.substring(F.md5(_col(key).cast("string")), 1, 12)
    return F.pmod(F.conv(hex12, 16, 10).cast("bigint"), F.lit(JITTER_RANGE_MICROS))


def event_time(step: str | Column, jitter_micros: Column | None = None,
               base: str = EVENT_TIME_BASE) -> Column:
    """``base + step hours (+ jitter µs)`` as ``TIMESTAMP_NTZ``."""
    t = F.timestamp_add("HOUR", _col(step), F.lit(base).cast("timestamp_ntz"))
    if jitter_micros is not None:
        t = F.timestamp_add("MICROSECOND", jitter_micros, t)
    return t


def balance_error(old: str | Column = "oldbalanceOrg", amount: str | Column = "amount",
                  new: str | Column = "newbalanceOrig") -> Column:
    """Signed ``(old - amount) - new``; evaluation order kept on purpose."""
    return (_col(old) - _col(amount)) - _col(new)


def is_corrupt(tol: float = CORRUPT_TOLERANCE, **cols) -> Column:
    """True when the balance does not add up (NULL if an input is NULL)."""
    return F.abs(balance_error(**cols)) > F.lit(tol)


def fraud_status(is_fraud: str | Column = "isFraud") -> Column:
    """``FRAUD`` for label 1, ``LEGIT`` otherwise (NULL included)."""
    return F.when(_col(is_fraud) == 1, F.lit(FRAUD_LABEL)).otherwise(F.lit(LEGIT_LABEL))


def money(c: str | Column, scale: int | None) -> Column:
    """Money value for exact aggregation: ``decimal(38, scale)`` or as is.

    Summing decimals is exact and therefore independent of partitioning and
    task order; summing doubles is not.
    """
    if scale is None:
        return _col(c)
    return _col(c).cast(f"decimal(38,{scale})")


MICROS_PER_HOUR = 3_600_000_000
_EPOCH_NTZ = "1970-01-01 00:00:00"


def hour_of(ts: str | Column) -> Column:
    """Floor a ``TIMESTAMP_NTZ`` to its hour with pure arithmetic.

    ``date_trunc`` would go through the session zone and return a zoned
    timestamp; this stays NTZ and zone-free.
    """
    epoch = F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, _col(ts))
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(MICROS_PER_HOUR)), _col(ts))

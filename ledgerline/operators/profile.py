"""Generic profiling of a file of unknown schema (CSV or JSON lines).

CSV output: input columns + ``processed_timestamp, processing_job, row_id``
+ one ``<c>_upper`` per string input column. JSON output: input columns +
``processed_timestamp, processing_job, record_count``. Each is a single
projection; the total count for JSON is counted first and added as a
literal (one number crosses to the driver, no rows).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value written into every processed row.
PROCESSING_JOB = "spark_airflow_job"


def _processed_at(processed_at: str | datetime | None) -> Column:
    """Job time as ``TIMESTAMP_NTZ`` (session-zone wall clock, constant in a
    query), or a fixed instant for repeatable runs."""
    if processed_at is None:
        return F.localtimestamp()
    return F.lit(processed_at).cast("timestamp_ntz")


def audit_columns(processed_at=None, job: str = PROCESSING_JOB) -> list[Column]:
    return [_processed_at(processed_at).alias("processed_timestamp"),
            F.lit(job).alias("processing_job")]


def row_id(df: DataFrame) -> Column:
    """``id * 2`` when an ``id`` column exists, else 0.

    Integers are doubled as bigint (no overflow), fractional ids keep their
    fraction, a text id is read as a number (NULL if it is none).
    """
    if "id" in df.columns:
        kind = df.schema["id"].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            return (F.col("id") * F.lit(2)).alias("row_id")
        if isinstance(kind, T.StringType):
            return (F.expr("try_cast(id AS double)") * F.lit(2)).alias("row_id")
        return (F.col("id").cast("bigint") * F.lit(2)).alias("row_id")
    return F.lit(0).alias("row_id")


def upper_copies(df: DataFrame) -> list[Column]:
    """``upper(c) AS c_upper`` for each string column, in input order."""
    return [F.upper(F.col(f"`{f.name}`")).alias(f"{f.name}_upper")
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def profile_csv_frame(df: DataFrame, processed_at=None, job: str = PROCESSING_JOB
                      ) -> DataFrame:
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*cols, *audit_columns(processed_at, job), row_id(df),
                     *upper_copies(df))


def with_record_count(df: DataFrame, col: str = "record_count") -> DataFrame:
    """Append the total row count as a constant ``bigint`` column.

    The count runs first as its own job (partial counts per task, one number
    to the driver); the result is a plain projection with a literal, so no
    join and no second input of the plan.
    """
    return df.withColumn(col, F.lit(df.count()).cast("bigint"))


def profile_json_frame(df: DataFrame, processed_at=None, job: str = PROCESSING_JOB
                       ) -> DataFrame:
    cols = [F.col(f"`{c}`") for c in df.columns]
    return with_record_count(df.select(*cols, *audit_columns(processed_at, job)))

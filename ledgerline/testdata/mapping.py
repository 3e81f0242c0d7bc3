"""Spark side of the test-data mapping (events JOIN customer -> RAW)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.split import split_feeds
from ledgerline.schemas import KEY, STEP

# Fixed values of the mapping (must equal the DuckDB side).
EVENTS_ORIGIN = "2024-01-01 00:00:00"   # step 1 = first hour of events
CORRUPT_EVERY = 7                       # every 7th event leaves the balance untouched
DEST_ACCOUNTS = 97                      # destination accounts M0..M96
DEST_BALANCE_MOD = 1000
FRAUD_EVERY = 11
FLAG_ABOVE = 150.0
# Fault injection for the quality operators.
WITHHOLD_ACCOUNTS_EVERY = 101
WITHHOLD_FRAUD_EVERY = 103
REPEAT_FRAUD_EVERY = 499
INCOMPLETE_STEP = 5


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RAW columns plus ``event_id`` (kept for ids and fault injection)."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    j = e.join(c, e["user_id"] == c["c_custkey"], "inner")
    eid, bal, val = F.col("event_id"), F.col("c_acctbal"), F.col("value")
    origin = F.lit(EVENTS_ORIGIN).cast("timestamp_ntz")
    dest_bal = (eid % DEST_BALANCE_MOD).cast("double")
    return j.select(
        eid,
        (F.timestamp_diff("HOUR", origin, F.col("ts")).cast("int") + 1).alias("step"),
        F.upper("event_type").alias("type"),
        val.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        bal.alias("oldbalanceOrg"),
        F.when(eid % CORRUPT_EVERY == 0, bal).otherwise(bal - val).alias("newbalanceOrig"),
        F.concat(F.lit("M"), (eid % DEST_ACCOUNTS).cast("string")).alias("nameDest"),
        dest_bal.alias("oldbalanceDest"),
        (dest_bal + val).alias("newbalanceDest"),
        F.when((eid % FRAUD_EVERY == 0)
               | ((F.col("event_type") == "error") & (eid % 2 == 0)), 1)
         .otherwise(0).alias("isFraud"),
        F.when(val > FLAG_ABOVE, 1).otherwise(0).alias("isFlaggedFraud"),
    )


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the 11 RAW columns."""
    return raw_events(spark, sf_dir).drop("event_id")


def raw_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW + ``event_id`` + a unique ``transaction_id`` built from ``event_id``."""
    raw = raw_events(spark, sf_dir)
    return raw.withColumn(KEY, F.concat_ws("-", F.lit("TXN"), F.col(STEP).cast("string"),
                                           F.col("event_id").cast("string")))


def feeds(spark: SparkSession, sf_dir: str, faulty: bool = False
          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three feeds (with ``step``). ``faulty`` injects the known defects:

    accounts withheld for ``event_id % 101 = 0``, fraud labels withheld for
    ``event_id % 103 = 0`` and for the whole of step 5, and fraud labels of
    ``event_id % 499 = 0`` delivered twice.
    """
    raw = raw_with_ids(spark, sf_dir)
    tx, acct, fraud = split_feeds(raw)
    if not faulty:
        return tx, acct, fraud
    eid = F.col("event_id")
    acct = split_feeds(raw.filter(eid % WITHHOLD_ACCOUNTS_EVERY != 0))[1]
    kept = raw.filter((eid % WITHHOLD_FRAUD_EVERY != 0)
                      & ~F.col(STEP).eqNullSafe(INCOMPLETE_STEP))
    fraud = split_feeds(kept.unionByName(kept.filter(eid % REPEAT_FRAUD_EVERY == 0)))[2]
    return tx, acct, fraud

"""Silver: join semantics, event time, balance check."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.silver import (
    add_is_corrupt, add_transaction_time, build_silver, join_feeds)
from ledgerline.schemas import SILVER_COLUMNS


def _feeds(spark):
    tx = spark.createDataFrame(
        [("a", 1, "T", 10.0, "C1", "M1"), ("b", 1, "T", 20.0, "C2", "M2"),
         ("c", 2, "T", 30.0, "C3", "M3"), (None, 2, "T", 1.0, "C4", "M4")],
        "transaction_id string, step int, type string, amount double, "
        "origin_account_id string, dest_account_id string")
    acct = spark.createDataFrame(
        [("a", 100.0, 90.0, 0.0, 10.0, 1), ("b", 100.0, 80.0, 0.0, 20.0, 1),
         ("c", 100.0, 70.0, 0.0, 30.0, 3), (None, 1.0, 0.0, 0.0, 1.0, 2)],
        "transaction_id string, oldbalanceOrg double, newbalanceOrig double, "
        "oldbalanceDest double, newbalanceDest double, step int")
    fraud = spark.createDataFrame(
        [("a", 0, 0, 1), ("b", 1, 1, 1), ("b", 1, 1, 1), ("c", 0, 0, 3), (None, 0, 0, 2)],
        "transaction_id string, isFraud int, isFlaggedFraud int, step int")
    return tx, acct, fraud


def test_join_is_batch_local_and_multiplies_duplicates(spark):
    tx, acct, fraud = _feeds(spark)
    got = join_feeds(tx, acct, fraud)
    ids = sorted(r[0] for r in got.select("transaction_id").collect())
    # 'c' is in another step in accounts; NULL keys never match; 'b' doubled
    assert ids == ["a", "b", "b"]
    assert got.columns == SILVER_COLUMNS[:-2]


def test_join_across_batches(spark):
    tx, acct, fraud = _feeds(spark)
    got = join_feeds(tx, acct, fraud, on=("transaction_id",))
    assert sorted(r[0] for r in got.select("transaction_id").collect()) == ["a", "b", "b", "c"]


def test_transaction_time_hash_jitter(spark):
    df = spark.range(2000).select(F.concat(F.lit("TXN-"), F.col("id").cast("string"))
                                  .alias("transaction_id"), (F.col("id") % 24 + 1).cast("int").alias("step"))
    a = add_transaction_time(df.repartition(1))
    b = add_transaction_time(df.repartition(17))
    assert a.exceptAll(b).count() == 0
    base = dt.datetime(2025, 1, 1)
    for r in a.collect():
        start = base + dt.timedelta(hours=r["step"])
        assert start <= r["transaction_time"] < start + dt.timedelta(hours=1)
    on_hour = add_transaction_time(df, "none").collect()
    assert all(r["transaction_time"] == base + dt.timedelta(hours=r["step"]) for r in on_hour)


def test_is_corrupt_boundaries_and_nulls(spark):
    df = spark.createDataFrame(
        [(100.0, 10.0, 90.0), (100.0, 10.0, 89.995), (100.0, 10.0, 89.98),
         (100.0, 10.0, 80.0), (None, 10.0, 90.0), (100.0, 10.0, 91.0)],
        "oldbalanceOrg double, amount double, newbalanceOrig double")
    got = [r["is_corrupt"] for r in add_is_corrupt(df).collect()]
    assert got == [False, False, True, True, None, True]


def test_build_silver_schema(spark):
    got = build_silver(*_feeds(spark))
    assert got.columns == SILVER_COLUMNS
    assert dict(got.dtypes)["transaction_time"] == "timestamp_ntz"


def test_hot_key_in_the_three_way_join_is_split(spark):
    # a third of the transactions share one key; AQE must split that key in
    # both chained joins (the second only with forceOptimizeSkewedJoin)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 150_000
        key = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("K"), F.col("id").cast("string")))
        tx = spark.range(n).select(
            key.alias("transaction_id"), F.lit(1).alias("step"), F.lit("T").alias("type"),
            F.rand(1).alias("amount"), F.md5(F.rand(2).cast("string")).alias("origin_account_id"),
            F.md5(F.rand(3).cast("string")).alias("dest_account_id"))
        ids = spark.range(n).select(F.concat(F.lit("K"), F.col("id").cast("string"))
                                    .alias("transaction_id")).union(
            spark.range(1).select(F.lit("HOT").alias("transaction_id")))
        acct = ids.select("transaction_id", *[F.lit(0.0).alias(c) for c in (
            "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")],
            F.lit(1).alias("step"))
        fraud = ids.select("transaction_id", F.lit(0).alias("isFraud"),
                           F.lit(0).alias("isFlaggedFraud"), F.lit(1).alias("step"))
        df = join_feeds(tx, acct, fraud)
        assert len(df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

"""Split side: per-step numbering, feed projections, batch sizes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.split import (
    batch_stats, ids_keep_step_layout, split_feeds, step_counts, with_transaction_id)
from ledgerline.schemas import RAW_SCHEMA


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def _row(step, amount, name="C1", fraud=0):
    return (step, "TRANSFER", amount, name, 100.0, 100.0 - amount, "M1", 0.0, amount, fraud, 0)


def test_ids_equal_row_number_with_hot_step(spark):
    # one step holds most rows and must be split over partitions
    rows = [_row(7, float(i), f"C{i % 13}") for i in range(3000)]
    rows += [_row(s, float(s), "C1") for s in range(1, 40)]
    rows += [_row(None, 1.0), _row(None, 2.0)]
    raw = _raw(spark, rows)
    got = with_transaction_id(raw, partitions=6)
    keys = [c for c in raw.columns if c != "step"]
    w = Window.partitionBy("step").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    want = raw.withColumn("transaction_id", F.concat_ws(
        "-", F.lit("TXN"), F.col("step").cast("string"),
        (F.row_number().over(w) - 1).cast("string")))
    assert got.count() == raw.count()
    assert got.select("transaction_id").distinct().count() == raw.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ids_stable_under_layout(spark):
    rows = [_row(s % 5 + 1, float(s), f"C{s}") for s in range(500)]
    raw = _raw(spark, rows)
    a = with_transaction_id(raw.repartition(1), partitions=3)
    b = with_transaction_id(raw.repartition(17), partitions=5)
    assert a.exceptAll(b).count() == 0


def test_ids_plan_has_one_sort_shuffle_and_bounded_broadcast(spark):
    raw = _raw(spark, [_row(s % 3, float(s)) for s in range(50)])
    df = with_transaction_id(raw.repartition(3), partitions=4)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "BroadcastHashJoin" in plan
    # both branches read the stored sorted copy, so they see the same partitions
    # whatever exchange the planner reuses
    assert "rangepartitioning" not in plan


def test_split_feeds_columns(spark):
    raw = with_transaction_id(_raw(spark, [_row(1, 5.0)]))
    tx, acct, fraud = split_feeds(raw)
    assert tx.columns == ["transaction_id", "step", "type", "amount",
                          "origin_account_id", "dest_account_id"]
    assert acct.columns == ["transaction_id", "oldbalanceOrg", "newbalanceOrig",
                            "oldbalanceDest", "newbalanceDest", "step"]
    assert fraud.columns == ["transaction_id", "isFraud", "isFlaggedFraud", "step"]
    _, acct2, fraud2 = split_feeds(raw, keep_step=False)
    assert "step" not in acct2.columns and "step" not in fraud2.columns


def test_step_counts_keeps_null_steps(spark):
    raw = _raw(spark, [_row(1, 1.0), _row(1, 2.0), _row(None, 3.0)])
    got = {r["step"]: r["rows"] for r in step_counts(raw).collect()}
    assert got == {1: 2, None: 1}


def test_batch_stats_counts_null_step_once(spark):
    raw = _raw(spark, [_row(1, 1.0), _row(1, 2.0), _row(3, 1.0), _row(None, 3.0),
                       _row(None, 4.0)])
    assert batch_stats(raw) == (5, 3)
    assert batch_stats(raw.filter("step = 99")) == (0, 0)


def test_ids_leave_rows_range_clustered_by_step(spark):
    # what the split job relies on to write the feeds without reshuffling:
    # every stored range holds one contiguous run of steps
    rows = [_row(7, float(i), f"C{i % 13}") for i in range(2000)]
    rows += [_row(s, float(s), f"C{s}") for s in range(1, 60) for _ in range(5)]
    raw = _raw(spark, rows).repartition(9)
    assert ids_keep_step_layout(6, 60)
    got = with_transaction_id(raw, partitions=6, n_steps=60)
    per_part = got.rdd.mapPartitions(lambda it: [[r["step"] for r in it]]).collect()
    assert sum(map(len, per_part)) == len(rows)
    # what a step-partitioned write needs: a step is in one partition, or in the two
    # at a range bound (a reader may pack several stored ranges into one partition)
    assert sum(len(set(p)) for p in per_part) <= 60 + 6
    # the hot step is cut over several partitions, so each holds a share
    assert sum(1 for p in per_part if 7 in p) > 1


def test_group_of_identical_copies_is_split_over_tasks(spark):
    # a third of all rows are copies of one row: equal sort keys, yet the
    # range partitioning must still cut the group, and ids stay exact
    rows = [_row(4, 9.0, "C9")] * 1500
    rows += [_row(s, float(i), f"C{i}") for i in range(3000) for s in (i % 50 + 1,)]
    raw = _raw(spark, rows).repartition(7)
    got = with_transaction_id(raw, partitions=6, n_steps=50)
    per_part = got.rdd.mapPartitions(
        lambda it: [sum(1 for r in it if r["nameOrig"] == "C9" and r["step"] == 4)]).collect()
    assert sum(per_part) == 1500 and max(per_part) < 1500
    keys = [c for c in raw.columns if c != "step"]
    w = Window.partitionBy("step").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    want = raw.withColumn("transaction_id", F.concat_ws(
        "-", F.lit("TXN"), F.col("step").cast("string"),
        (F.row_number().over(w) - 1).cast("string")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

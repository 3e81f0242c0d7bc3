"""Incremental silver with Structured Streaming: new files only, late data."""

from pyspark.sql import functions as F

from ledgerline.plans import registry
from ledgerline.schemas import FEEDS
from ledgerline.sinks import writers
from ledgerline.sources import files as file_src
from ledgerline.streaming.silver_stream import run_silver_stream_once, start_silver_stream
from ledgerline.testdata import mapping

from conftest import SF001


def _land(spark, feeds, root, steps):
    part = {n: d.filter(F.col("step").isin(steps)) for n, d in feeds.items()}
    for name, df in part.items():
        df.write.mode("append").partitionBy("step").parquet(f"{root}/{name}")


def test_incremental_runs_and_late_labels(spark, scratch):
    tx, acct, fraud = mapping.feeds(spark, SF001)
    feeds = dict(zip(FEEDS, (tx, acct, fraud)))
    bronze, sink, ckpt = scratch + "/bronze", scratch + "/sink", scratch + "/ckpt"

    def rows():
        return file_src.read_table(spark, sink).count()

    def n(steps):
        return tx.filter(F.col("step").isin(steps)).count()

    # run 1: steps 1-3 complete
    _land(spark, feeds, bronze, [1, 2, 3])
    run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3])
    # a run with no new files adds nothing
    run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3])
    # run 2: steps 10-11; the watermark moves past step 3
    _land(spark, feeds, bronze, [10, 11])
    st = run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3, 10, 11])
    # join state is disk-backed and holds only steps within the watermark:
    # two joins x two sides x the rows of steps 10-11, nothing of steps 1-3
    assert st["state_store"] == "rocksdb"
    assert n([1, 2, 3]) > 0 and 0 < st["state_rows"] <= 4 * n([10, 11])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    # run 3: transactions+accounts of step 12 now, its labels in run 4
    _land(spark, {"transactions": tx, "accounts": acct}, bronze, [12])
    run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3, 10, 11])
    _land(spark, {"fraud": fraud}, bronze, [12])
    run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3, 10, 11, 12])
    # run 5: a full step 1 again is far behind the watermark and is dropped
    _land(spark, feeds, bronze, [1])
    run_silver_stream_once(spark, bronze, sink, ckpt, watermark="2 hours")
    assert rows() == n([1, 2, 3, 10, 11, 12])


def test_no_watermark_joins_across_runs(spark, scratch):
    tx, acct, fraud = mapping.feeds(spark, SF001)
    bronze, sink, ckpt = scratch + "/bronze", scratch + "/sink", scratch + "/ckpt"
    steps = [1, 2]
    _land(spark, {"transactions": tx, "accounts": acct}, bronze, steps)
    _land(spark, {"fraud": fraud.limit(0)}, bronze, steps)   # folder provisioned, empty
    run_silver_stream_once(spark, bronze, sink, ckpt, state_partitions=4)
    inv = file_src.file_inventory(spark, sink)
    assert inv.filter(F.col("file_path").endswith(".parquet")).count() == 0
    _land(spark, {"fraud": fraud}, bronze, steps)
    stats = run_silver_stream_once(spark, bronze, sink, ckpt, state_partitions=4)
    want = tx.filter(F.col("step").isin(steps)).count()
    assert stats["input_rows"] == fraud.filter(F.col("step").isin(steps)).count()
    got = file_src.read_table(spark, sink)
    assert got.count() == want
    assert got.filter(F.col("transaction_time").isNull()).count() == 0


def _small_feeds(spark, steps):
    """Two rows per step, the second twice in every feed, and an account row without partners."""
    ids = spark.createDataFrame([(f"TXN-{s}-{i}", s) for s in steps for i in (0, 1, 1)],
                                "transaction_id string, step int")
    money = [F.lit(float(n)).alias(c) for n, c in enumerate(
        ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"))]
    alone = spark.createDataFrame([("TXN-alone", steps[-1])], ids.schema)
    return {"transactions": ids.select("transaction_id", F.lit("PURCHASE").alias("type"), F.lit(1.0).alias("amount"),
                                       F.lit("C1").alias("origin_account_id"),
                                       F.lit("M1").alias("dest_account_id"), "step"),
            "accounts": ids.union(alone).select("transaction_id", *money, "step"),
            "fraud": ids.select("transaction_id", F.lit(0).alias("isFraud"), F.lit(1).alias("isFlaggedFraud"), "step")}


def test_uncounted_state_reads_less_and_gives_the_same(spark, scratch):
    steps = [1, 2, 3, 10, 11]
    bronze = scratch + "/bronze"
    _land(spark, _small_feeds(spark, steps), bronze, steps)
    rows, gets, stats = {}, {}, {}
    for counted in (True, False):
        at = f"{scratch}/{counted}"
        q = start_silver_stream(spark, bronze, at + "/sink", at + "/ckpt", watermark="2 hours",
                                state_partitions=2, count_state=counted)
        q.awaitTermination()
        assert q.exception() is None
        progress = [p if isinstance(p, dict) else p.jsonValue() for p in q.recentProgress]
        gets[counted] = sum(op["customMetrics"]["rocksdbGetCount"] for p in progress for op in p["stateOperators"])
        rows[counted] = sorted(file_src.read_table(spark, at + "/sink").collect())
        stats[counted] = run_silver_stream_once(spark, bronze, at + "/sink2", at + "/ckpt2", watermark="2 hours",
                                                state_partitions=2, count_state=counted)
    # per step one row, and 2 x 2 x 2 of the doubled id
    assert rows[False] == rows[True] and len(rows[True]) == 9 * len(steps)
    assert 0 < gets[False] < gets[True]
    assert stats[False] == stats[True] and stats[True]["state_rows"] > 0
    # the rows in state are unknown without counting once the checkpoint is not new
    _land(spark, _small_feeds(spark, [12]), bronze, [12])
    at = f"{scratch}/False"
    again = run_silver_stream_once(spark, bronze, at + "/sink2", at + "/ckpt2", watermark="2 hours", count_state=False)
    assert again["state_rows"] is None and again["input_rows"] == 10
    assert file_src.read_table(spark, at + "/sink2").count() == 9 * (len(steps) + 1)


def test_stream_queries_do_not_count_state(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(registry, "_bronze", lambda *a, **b: "bronze")
    monkeypatch.setattr(registry, "_read_silver", lambda *a: None)
    monkeypatch.setattr(registry.stream, "run_silver_stream_once", lambda *a, **b: asked.append(b))
    registry.QUERIES["silver_stream"](spark, SF001)
    registry.QUERIES["silver_stream_bounded"](spark, SF001)
    assert [b.get("count_state") for b in asked] == [False, False]

"""Job entry points, the loss report, removed staging, and listing of single steps."""

import os

import pytest

from ledgerline.plans import gold_job, profile_job, silver_job, split_job
from ledgerline.session import checkpoint_root, drop_scratch
from ledgerline.sinks import writers
from ledgerline.sources import feeds as feed_src
from ledgerline.testdata import mapping


SF001 = "/root/testdata/sf0.001"


def test_jobs_run_from_their_arguments(spark, scratch, capsys):
    raw = mapping.raw_table(spark, SF001).where("step <= 2")
    writers.write_any(raw, scratch + "/raw", "csv")
    staged = lambda: {d for d in os.listdir(
        checkpoint_root(spark).removeprefix("file:") + "/ledgerline") if d.startswith("split-stage")}
    before = staged()
    split_job.main([scratch + "/raw", scratch + "/bronze"])
    assert staged() == before
    silver_job.main([scratch + "/bronze", scratch + "/silver"])
    one = raw.where("step = 1").count()
    silver = spark.read.parquet(scratch + "/silver")
    assert silver.count() == one == silver.where("step = 1").count()
    silver_job.main([scratch + "/bronze", scratch + "/silver", "--all"])
    assert spark.read.parquet(scratch + "/silver").count() == raw.count()
    assert "'unmatched': {'transactions': 0, 'accounts': 0, 'fraud': 0}" in capsys.readouterr().out
    gold_job.main([scratch + "/silver", scratch + "/gold", "SYSTEM_AUDIT"])
    assert os.listdir(scratch.removeprefix("file:") + "/gold") == ["SYSTEM_AUDIT"]
    profile_job.main([scratch + "/raw", scratch + "/profiled"])
    assert spark.read.option("header", True).csv(scratch + "/profiled").count() == raw.count()


def test_unmatched_rows_are_reported(spark, scratch):
    tx, acct, fraud = mapping.feeds(spark, SF001)
    step = tx.agg({"step": "min"}).first()[0]
    feeds = [d.where(f"step = {step}") for d in (tx, acct, fraud)]
    gone = feeds[1].orderBy("transaction_id").limit(1)
    feeds[1] = feeds[1].join(gone, "transaction_id", "left_anti").select(*acct.columns)
    writers.write_feeds(dict(zip(("transactions", "accounts", "fraud"), feeds)), scratch + "/b")
    stats = silver_job.run_silver(spark, scratch + "/b", scratch + "/s", report_unmatched=True)
    assert stats["unmatched"] == {"transactions": 0, "accounts": 1, "fraud": 0}


def test_only_the_selected_steps_are_listed(spark, scratch):
    tx = mapping.feeds(spark, SF001)[0].where("step <= 3")
    writers.write_feeds({"transactions": tx}, scratch, "parquet")
    # another step's folder that no reader could open does not matter
    bad = scratch.removeprefix("file:") + "/transactions/step=9"
    os.makedirs(bad)
    with open(bad + "/part-0.parquet", "w") as f:
        f.write("not parquet")
    got = feed_src.read_feed(spark, scratch, "transactions", steps=[2, 3, 77], fmt="parquet")
    assert all("step=9" not in f for f in got.inputFiles())
    assert got.count() == tx.where("step IN (2, 3)").count()
    none = feed_src.read_feed(spark, scratch, "transactions", steps=77, fmt="parquet")
    assert none.count() == 0 and none.columns == got.columns


def test_only_scratch_folders_are_removed(spark, scratch):
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")

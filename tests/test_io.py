"""Sources, sinks and the generic profile job."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.profile import profile_csv_frame, profile_json_frame
from ledgerline.plans import gold_job, profile_job, silver_job, split_job
from ledgerline.schemas import FEEDS, SILVER_COLUMNS
from ledgerline.sinks import writers
from ledgerline.sources import feeds as feed_src
from ledgerline.sources import files as file_src
from ledgerline.sources.sample import sample_customer_range
from ledgerline.testdata import mapping

from conftest import SF001, SF01


def test_write_batch_replace_is_idempotent_and_append_doubles(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "transaction_id string, step int")
    writers.write_batch(df, scratch + "/r")
    writers.write_batch(df, scratch + "/r")
    assert file_src.read_table(spark, scratch + "/r").count() == 2
    writers.write_batch(df, scratch + "/a", mode="append")
    writers.write_batch(df, scratch + "/a", mode="append")
    assert file_src.read_table(spark, scratch + "/a").count() == 4
    # replace touches only the steps present in the new batch
    writers.write_batch(df.filter("step = 1"), scratch + "/r")
    assert file_src.read_table(spark, scratch + "/r").count() == 2
    # overwrite replaces the whole table: steps missing from the batch vanish
    writers.write_batch(df, scratch + "/o", mode="overwrite")
    writers.write_batch(df.filter("step = 1"), scratch + "/o", mode="overwrite")
    assert [r["step"] for r in file_src.read_table(spark, scratch + "/o").collect()] == [1]
    with pytest.raises(ValueError):
        writers.write_batch(df, scratch + "/x", mode="merge")


def test_whole_number_batch_keeps_double(spark, scratch):
    tx = spark.createDataFrame([("a", 5, "T", 100.0, "C", "M"), ("b", 5, "T", 200.0, "C", "M")],
                               "transaction_id string, step int, type string, amount double, "
                               "origin_account_id string, dest_account_id string")
    writers.write_feeds({"transactions": tx}, scratch, "csv")
    back = feed_src.read_feed(spark, scratch, "transactions", steps=5)
    assert dict(back.dtypes)["amount"] == "double"
    assert back.count() == 2


def test_batch_select_prunes_partitions(spark, scratch):
    tx = spark.createDataFrame([("a", 1, "T", 1.0, "C", "M"), ("b", 2, "T", 2.0, "C", "M")],
                               "transaction_id string, step int, type string, amount double, "
                               "origin_account_id string, dest_account_id string")
    writers.write_feeds({"transactions": tx}, scratch, "parquet")
    df = feed_src.read_feed(spark, scratch, "transactions", steps=[2], fmt="parquet")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(step" in plan and "step" in plan
    assert [r["transaction_id"] for r in df.collect()] == ["b"]


def test_split_silver_gold_end_to_end(spark, scratch):
    raw = mapping.raw_table(spark, SF001)
    report = split_job.run_split(spark, raw, scratch + "/bronze")
    assert all(r["ok"] for r in report.collect())
    stats = silver_job.run_silver(spark, scratch + "/bronze", scratch + "/silver")
    assert stats["rows"] == raw.count()
    assert file_src.read_table(spark, scratch + "/silver").count() == raw.count()
    done = gold_job.run_gold(spark, scratch + "/silver", gold_job.to_files(scratch + "/gold"))
    assert len(done) == 4
    audit = file_src.read_table(spark, scratch + "/gold/SYSTEM_AUDIT").collect()
    assert len(audit) == 5


def test_split_writes_about_one_file_per_step_and_task(spark, scratch):
    import glob
    raw = mapping.raw_table(spark, SF001)
    steps = raw.select("step").distinct().count()
    report = split_job.run_split(spark, raw, scratch + "/feeds", fmt="parquet", partitions=4)
    assert all(r["ok"] and r["rows_in"] == raw.count() for r in report.collect())
    for feed in ("transactions", "accounts", "fraud"):
        local = scratch.removeprefix("file:")
        files = glob.glob(f"{local}/feeds/{feed}/step=*/*.parquet")
        assert steps <= len(files) <= steps + 4


def test_single_step_silver_run_writes_one_file_per_task(spark, scratch):
    import glob
    raw = mapping.raw_table(spark, SF01)
    split_job.run_split(spark, raw, scratch + "/bronze")
    step = raw.groupBy("step").count().orderBy(F.desc("count"), "step").first()["step"]
    stats = silver_job.run_silver(spark, scratch + "/bronze", scratch + "/silver", steps=step)
    want = raw.filter(F.col("step") == step).count()
    assert stats["rows"] == want
    back = file_src.read_table(spark, scratch + "/silver")
    assert back.count() == want and back.filter(F.col("step") != step).count() == 0
    files = glob.glob(scratch.removeprefix("file:") + f"/silver/step={step}/*.parquet")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 1 <= len(files) <= parts


def test_rerun_of_split_converges(spark, scratch):
    # a job retried after a failure writes the same feeds again, not twice
    raw = mapping.raw_table(spark, SF001)
    split_job.run_split(spark, raw, scratch + "/f", fmt="parquet")
    first = feed_src.read_feed(spark, scratch + "/f", "transactions", fmt="parquet")
    first = first.collect()
    report = split_job.run_split(spark, raw, scratch + "/f", fmt="parquet")
    assert all(r["ok"] for r in report.collect())
    again = feed_src.read_feed(spark, scratch + "/f", "transactions", fmt="parquet").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first))


def test_clustered_write_splits_a_group_of_copies(spark, scratch):
    hot = [("TXN-1-0", 1, "T", 5.0, "C", "M")] * 3000
    rest = [(f"TXN-{i % 20 + 1}-{i + 1}", i % 20 + 1, "T", 1.0, "C", "M") for i in range(3000)]
    tx = spark.createDataFrame(hot + rest, "transaction_id string, step int, type string, "
                               "amount double, origin_account_id string, dest_account_id string")
    writers.write_batch(tx.repartition(5), scratch + "/t", fmt="parquet", partitions=6)
    back = file_src.read_table(spark, scratch + "/t")
    assert back.count() == 6000
    per_file = (back.filter(F.col("transaction_id") == "TXN-1-0")
                .groupBy(F.col("_metadata.file_path")).count().collect())
    assert sum(r["count"] for r in per_file) == 3000
    assert max(r["count"] for r in per_file) < 3000


def test_land_batch_refuses_incomplete_steps(spark, scratch):
    tx, acct, fraud = mapping.feeds(spark, SF001, faulty=True)
    feeds = dict(zip(FEEDS, (tx, acct, fraud)))
    with pytest.raises(writers.IncompleteBatchError):
        writers.land_batch(spark, feeds, scratch + "/landed", steps=[4, 5, 6])
    rep = writers.land_batch(spark, feeds, scratch + "/landed", steps=[4, 6])
    assert rep.count() == 2
    assert not os.path.exists(scratch.replace("file:", "") + "/landed/fraud/step=5")
    # a single step lands unclustered and replaces only itself
    writers.land_batch(spark, feeds, scratch + "/landed", steps=[6])
    back = feed_src.read_feed(spark, scratch + "/landed", "transactions", fmt="parquet")
    want = {s: tx.filter(F.col("step") == s).count() for s in (4, 6)}
    got = {r["step"]: r["count"] for r in back.groupBy("step").count().collect()}
    assert got == want


def test_write_warehouse_sets_table_option(spark, scratch):
    df = spark.createDataFrame([(1,)], "x int")
    writers.write_warehouse(df, "T1", {"path": scratch + "/wh"}, fmt="parquet")
    assert file_src.read_table(spark, scratch + "/wh").count() == 1


def test_profile_csv_rules(spark, scratch):
    src = sample_customer_range(spark, 100)
    writers.write_any(src, scratch + "/in", "csv")
    out = profile_job.profile_frame(spark, scratch + "/in", "csv", "2025-01-01 00:00:00")
    types = dict(out.dtypes)
    assert types["purchase_date"] == "date"
    assert "purchase_date_upper" not in types and "age_upper" not in types
    assert [c for c in out.columns if c.endswith("_upper")] == [
        "name_upper", "city_upper", "category_upper"]
    first = out.orderBy("id").first()
    assert (first["id"], first["name"], first["age"], first["city"], first["score"]) == (
        1, "Customer_1", 20, "New York", 70)
    assert first["row_id"] == 2 and first["name_upper"] == "CUSTOMER_1"
    last = out.orderBy(F.desc("id")).first()
    assert (last["age"], last["purchase_amount"], str(last["purchase_date"]), last["score"]) == (
        69, 1139.5, "2024-04-09", 79)
    no_id = profile_csv_frame(spark.createDataFrame([("x",)], "s string"))
    assert no_id.first()["row_id"] == 0


def test_profile_json_record_count(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "s string, n long")
    writers.write_any(df, scratch + "/in", "json")
    out = profile_job.profile_frame(spark, scratch + "/in", "json")
    assert {r["record_count"] for r in out.collect()} == {3}
    profile_job.run_profile(spark, scratch + "/in", scratch + "/out", "json", files=1)
    inv = file_src.file_inventory(spark, scratch + "/out")
    data = inv.filter(F.col("file_path").endswith(".json"))
    assert data.count() == 1
    summary = file_src.inventory_summary(data).first()
    assert summary["ok"] and summary["total_bytes"] > 0
    lines = file_src.first_lines(spark, scratch + "/out", 5).collect()
    assert len(lines) == 3 and '"record_count":3' in lines[0]["line"]
    assert profile_json_frame(df).columns[-1] == "record_count"


def test_read_any_rejects_unknown_format(spark):
    with pytest.raises(ValueError):
        file_src.read_any(spark, "/nowhere", "xml")


def test_silver_columns_after_round_trip(spark, scratch):
    writers.write_feeds(dict(zip(FEEDS, mapping.feeds(spark, SF001))), scratch + "/b")
    silver_job.run_silver(spark, scratch + "/b", scratch + "/s", steps=[1, 2, 3])
    back = file_src.read_table(spark, scratch + "/s")
    assert sorted(back.columns) == sorted(SILVER_COLUMNS)
    assert {r["step"] for r in back.select("step").distinct().collect()} <= {1, 2, 3}


def test_rebalance_layout_writes_same_rows(spark, scratch):
    df = spark.range(3000).selectExpr("cast(id as string) as transaction_id",
                                      "cast(case when id < 2000 then 1 else id % 7 end as int) as step")
    writers.write_batch(df, scratch + "/rb", layout="rebalance")
    writers.write_batch(df, scratch + "/rg", partitions=5)
    a, b = file_src.read_table(spark, scratch + "/rb"), file_src.read_table(spark, scratch + "/rg")
    assert a.count() == 3000 and a.exceptAll(b.select(*a.columns)).count() == 0


def test_read_raw_csv_then_split(spark, scratch):
    raw = mapping.raw_table(spark, SF001)
    writers.write_any(raw, scratch + "/raw", "csv")
    back = feed_src.read_raw(spark, scratch + "/raw")
    assert dict(back.dtypes) == dict(raw.dtypes)
    assert back.exceptAll(raw).count() == 0 and back.count() == raw.count()
    report = split_job.run_split(spark, back, scratch + "/feeds", fmt="parquet")
    assert all(r["ok"] for r in report.collect())

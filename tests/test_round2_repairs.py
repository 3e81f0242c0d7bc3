"""Ids that do not depend on the plan, header checks, whole landings, exact money, loud streams."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.columns import money
from ledgerline.operators.gold import MONEY_SCALE
from ledgerline.operators.profile import row_id
from ledgerline.operators.split import with_transaction_id
from ledgerline.plans.gold_job import run_gold
from ledgerline.schemas import RAW_SCHEMA
from ledgerline.sinks.writers import IncompleteBatchError, land_batch
from ledgerline.sources.feeds import read_raw
from ledgerline.streaming.silver_stream import start_silver_stream


@pytest.mark.parametrize("order_by,reuse", [(None, "true"), (["amount"], "true"), (None, "false")])
def test_ids_are_whole_for_any_order_and_plan(spark, order_by, reuse):
    raw = spark.range(300_000, numPartitions=6).select(
        (F.col("id") % 3).cast("int").alias("step"), (F.rand(1) * 1000).alias("amount"),
        F.col("id").cast("string").alias("nameOrig"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = with_transaction_id(raw, order_by).select(
            "step", "nameOrig", F.split("transaction_id", "-")[2].cast("long").alias("n")) \
            .groupBy("step").agg(F.count("*").alias("rows"), F.countDistinct("n").alias("ids"),
                                 F.countDistinct("nameOrig").alias("names"),
                                 F.min("n").alias("low"), F.max("n").alias("high")).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert {tuple(r)[1:] for r in got} == {(100_000, 100_000, 100_000, 0, 99_999)}


def test_header_in_another_order_is_refused(spark, scratch):
    names = [f.name for f in RAW_SCHEMA.fields]
    i, j = names.index("oldbalanceOrg"), names.index("newbalanceOrig")
    row = ["1", "PAYMENT", "2.5", "a", "10", "7.5", "b", "0", "0", "0", "0"]
    good = spark.createDataFrame([tuple(row)], names)
    good.write.option("header", True).csv(scratch + "/good")
    assert read_raw(spark, scratch + "/good").first()["oldbalanceOrg"] == 10
    names[i], names[j] = names[j], names[i]
    good.select(*names).write.option("header", True).csv(scratch + "/bad")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, scratch + "/bad").collect()


def test_landing_needs_all_feeds(spark, scratch):
    one = spark.createDataFrame([("TXN-1-0", 1)], "transaction_id string, step int")
    with pytest.raises(IncompleteBatchError):
        land_batch(spark, {"transactions": one, "accounts": one}, scratch)
    other = one.withColumn("step", F.lit(2))
    with pytest.raises(IncompleteBatchError) as e:
        land_batch(spark, {"transactions": one, "accounts": one, "fraud": other}, scratch)
    assert e.value.report.count() == 2


def test_money_keeps_small_and_large_values(spark):
    total = lambda v, n: spark.range(n).select(
        F.sum(money(F.lit(v), MONEY_SCALE)).cast("double").alias("s")).first()["s"]
    assert total(0.004, 86) == 0.344
    assert total(1e17, 3) == 3e17


def test_row_id_by_type(spark):
    for kind, value, want in (("double", 1.5, 3.0), ("int", 2**31 - 1, 2**32 - 2), ("string", "x", None)):
        df = spark.createDataFrame([(value,)], f"id {kind}")
        assert df.select(row_id(df)).first()["row_id"] == want


def test_unknown_gold_table_and_bounded_watermark_are_refused(spark, scratch):
    with pytest.raises(ValueError):
        run_gold(spark, scratch, lambda df, name: None, tables=["NO_SUCH"])
    with pytest.raises(ValueError):
        start_silver_stream(spark, scratch, scratch, scratch, watermark="2 hours",
                            max_files_per_trigger=1)

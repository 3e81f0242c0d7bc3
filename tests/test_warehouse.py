"""The warehouse sink: options as passed, aborts that leave nothing, releases as a whole."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.gold import GOLD_TABLES
from ledgerline.plans import gold_job
from ledgerline.sinks import warehouse as W
from ledgerline.sinks import writers
from ledgerline.testdata import mapping
from ledgerline.operators.silver import build_silver

from conftest import SF001


def files(path):
    path = path.replace("file:", "")
    return sorted(os.path.relpath(os.path.join(d, n), path) for d, _, ns in os.walk(path) for n in ns)


def test_options_reach_the_source(spark, scratch, monkeypatch):
    """``dbtable`` and every caller option arrive under their names, with mode overwrite."""
    W.to_release(spark, scratch, "r1")
    df = spark.range(3)
    with pytest.raises(Exception, match="missing options \\['release'\\]"):
        writers.write_warehouse(df, "T1", {"path": scratch}, W.FORMAT)
    with pytest.raises(Exception, match="overwrite"):
        writers.write_warehouse(df, "T1", {"path": scratch, "release": "r1"}, W.FORMAT, mode="append")
    with pytest.raises(Exception, match="letters"):
        writers.write_warehouse(df, "../T1", {"path": scratch, "release": "r1"}, W.FORMAT)
    writers.write_warehouse(df, "T1", {"path": scratch, "release": "r1"}, W.FORMAT)
    assert [f for f in files(scratch) if f.endswith(".json")] == ["releases/r1/T1.json"]
    calls = {}

    class Spy:
        def format(self, f):
            calls["format"] = f
            return self

        def options(self, **o):
            calls["options"] = o
            return self

        def option(self, k, v):
            calls.setdefault("option", {})[k] = v
            return self

        def mode(self, m):
            calls["mode"] = m
            return self

        def save(self):
            calls["saved"] = True

    class Frame:
        write = Spy()
    writers.write_warehouse(Frame(), "GOLD", {"url": "u", "user": "me"})
    assert calls == {"format": "jdbc", "options": {"url": "u", "user": "me"},
                     "option": {"dbtable": "GOLD"}, "mode": "overwrite", "saved": True}


def test_an_aborted_write_leaves_nothing(spark, scratch):
    for parts, release in ((1, "r1"), (4, "r2")):
        bad = spark.range(0, 40000, numPartitions=parts).select(
            F.when(F.col("id") == 39999, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
        with pytest.raises(Exception):
            W.to_release(spark, scratch, release)(bad, "T1")
        assert not [f for f in files(scratch) if f.endswith(".json")]
        assert files(f"{scratch}/releases/r1") == []
    with pytest.raises(RuntimeError, match="lacks"):
        W.publish(spark, scratch, "r1", ["T1"])
    with pytest.raises(LookupError):
        W.read_warehouse(spark, scratch, "T1")
    # a task may outlive the abort: what it leaves is in no table and goes with the cleaning
    W.to_release(spark, scratch, "r3")(spark.range(5), "T1")
    W.publish(spark, scratch, "r3", ["T1"])
    W.drop_old_releases(spark, scratch)
    assert os.listdir(f"{scratch}/releases".replace("file:", "")) == ["r3"]


def test_the_gold_tables_appear_together(spark, scratch):
    silver = build_silver(*mapping.feeds(spark, SF001))
    silver.write.parquet(scratch + "/silver")
    root = scratch + "/wh"
    first = W.new_release()
    gold_job.run_gold(spark, scratch + "/silver", W.to_release(spark, root, first))
    with pytest.raises(LookupError):        # written, not yet published
        W.read_warehouse(spark, root, "SYSTEM_AUDIT")
    W.publish(spark, root, first, GOLD_TABLES)
    before = {t: W.read_warehouse(spark, root, t).count() for t in GOLD_TABLES}
    assert before["TRANSACTION_TRENDS_DETAILED"] == silver.count() and all(before.values())

    # the next refresh dies after two tables: readers keep all four of the first
    second, done = W.new_release(), []

    def dying(df, name):
        if len(done) == 2:
            raise OSError("killed")
        W.to_release(spark, root, second)(df.limit(1), name)
        done.append(name)
    with pytest.raises(OSError):
        gold_job.run_gold(spark, scratch + "/silver", dying)
    with pytest.raises(RuntimeError):
        W.publish(spark, root, second, GOLD_TABLES)
    assert {t: W.read_warehouse(spark, root, t).count() for t in GOLD_TABLES} == before

    third = W.new_release()
    gold_job.run_gold(spark, scratch + "/silver", W.to_release(spark, root, third))
    assert W.publish(spark, root, third, GOLD_TABLES) == 2
    assert sorted(W.drop_old_releases(spark, root)) == sorted([first, second])
    assert {t: W.read_warehouse(spark, root, t).count() for t in GOLD_TABLES} == before


def test_files_of_failed_or_repeated_tasks_are_no_rows(spark, scratch):
    W.to_release(spark, scratch, "r1")
    W.to_release(spark, scratch, "r1")(spark.range(10), "T1")
    where = f"{scratch}/releases/r1/T1".replace("file:", "")
    part = next(n for n in os.listdir(where) if n.endswith(".parquet"))
    with open(f"{where}/{part}", "rb") as f, open(f"{where}/part-00000-again.parquet", "wb") as g:
        g.write(f.read())
    W.publish(spark, scratch, "r1", ["T1"])
    assert W.read_warehouse(spark, scratch, "T1").count() == 10


def test_a_table_without_rows(spark, scratch):
    W.to_release(spark, scratch, "r1")(spark.range(0), "T1")
    W.publish(spark, scratch, "r1", ["T1"])
    got = W.read_warehouse(spark, scratch, "T1")
    assert got.dtypes == [("id", "bigint")] and got.count() == 0

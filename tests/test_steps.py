"""Replacing named steps: emptied steps go, a killed run leaves the old or the new state."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.folders import Folders
from ledgerline.plans import silver_job
from ledgerline.schemas import FEEDS
from ledgerline.sinks import steps as S
from ledgerline.sinks import writers
from ledgerline.testdata import mapping

from conftest import SF01

SCHEMA = "transaction_id string, v int, step int"


def table(spark, values):
    """step -> value, as rows."""
    rows = [(f"t{s}-{i}", v, s) for s, v in values.items() for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, path):
    got = S.read_steps(spark, path, SCHEMA).groupBy("step").agg(F.min("v"), F.max("v"), F.count("*"))
    out = {}
    for step, low, high, n in got.collect():
        assert low == high and n == 3
        out[step] = low
    return out


def plain(path):
    return path.replace("file:", "")


def test_emptied_and_new_steps(spark, scratch):
    S.replace_steps(table(spark, {1: 1, 2: 1, 3: 1}), scratch, [1, 2, 3])
    assert state(spark, scratch) == {1: 1, 2: 1, 3: 1}
    # step 2 has no rows any more, step 4 is new, step 9's rows were not asked for
    S.replace_steps(table(spark, {3: 2, 4: 2, 9: 2}), scratch, [2, 3, 4])
    assert state(spark, scratch) == {1: 1, 3: 2, 4: 2}
    assert spark.read.parquet(scratch).count() == 9     # any reader sees the same
    assert sorted(n for n in os.listdir(plain(scratch)) if "=" in n) == ["step=1", "step=3", "step=4"]
    S.replace_steps(table(spark, {}), scratch, [1, 3, 4])
    assert state(spark, scratch) == {}


class Killed(Exception):
    pass


@pytest.mark.parametrize("at", [0, 1, 3, 5, 7, 9, 10])
def test_a_run_killed_at_any_move_leaves_the_old_or_the_new_state(spark, scratch, monkeypatch, at):
    S.replace_steps(table(spark, {1: 1, 2: 1, 3: 1}), scratch, [1, 2, 3])
    old, new = {1: 1, 2: 1, 3: 1}, {1: 2, 3: 2, 4: 2}
    calls = []

    def dying(name):
        real = getattr(Folders, name)

        def run(self, *args):
            calls.append(name)
            if len(calls) > at:
                raise Killed
            return real(self, *args)
        monkeypatch.setattr(Folders, name, run)
    for name in ("move", "delete"):
        dying(name)
    committed = False
    try:
        S.replace_steps(table(spark, {1: 2, 3: 2, 4: 2}), scratch, [1, 2, 3, 4])
        committed = True
    except Killed:
        pass
    monkeypatch.undo()
    seen = state(spark, scratch)
    assert seen == (new if at else old)     # the first move is the record's
    assert committed == (at > 7 + 2)
    S.recover(spark, scratch)
    assert state(spark, scratch) == seen
    assert spark.read.parquet(scratch).groupBy("step").count().count() == len(seen)
    left = [n for n in os.listdir(plain(scratch)) if n[0] == "_" and
            os.path.isdir(f"{plain(scratch)}/{n}") and os.listdir(f"{plain(scratch)}/{n}")]
    assert left in ([], ["_log"]) and not any(
        n.endswith(".json") and n[0] != "." for n in os.listdir(f"{plain(scratch)}/_log"))
    # a further run works on whatever was left
    S.replace_steps(table(spark, {5: 7}), scratch, [5])
    assert state(spark, scratch) == {**seen, 5: 7}


def test_a_run_killed_while_writing_leaves_the_old_state(spark, scratch, monkeypatch):
    S.replace_steps(table(spark, {1: 1}), scratch, [1])
    real = S.write_batch

    def dying(df, path, **kw):
        real(df.limit(1), path, **kw)
        raise Killed
    monkeypatch.setattr(S, "write_batch", dying)
    with pytest.raises(Killed):
        S.replace_steps(table(spark, {1: 2}), scratch, [1])
    monkeypatch.undo()
    assert state(spark, scratch) == {1: 1}
    S.replace_steps(table(spark, {2: 2}), scratch, [2])
    assert state(spark, scratch) == {1: 1, 2: 2}


def test_silver_job_clears_a_step_that_lost_its_feed(spark, scratch):
    def some(faulty):
        feeds = zip(FEEDS, mapping.feeds(spark, SF01, faulty=faulty))
        return {n: d.where("step BETWEEN 4 AND 6") for n, d in feeds}
    writers.write_feeds(some(False), scratch + "/b")
    silver_job.run_silver(spark, scratch + "/b", scratch + "/s", steps=[4, 5, 6])
    full = S.read_steps(spark, scratch + "/s").groupBy("step").count().collect()
    assert {r["step"] for r in full} == {4, 5, 6}
    writers.write_feeds(some(True), scratch + "/b2")
    silver_job.run_silver(spark, scratch + "/b2", scratch + "/s", steps=[4, 5])
    got = {r["step"] for r in S.read_steps(spark, scratch + "/s").select("step").distinct().collect()}
    assert got == {4, 6}

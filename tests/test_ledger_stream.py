"""The accounting stream: replays, dead batches, late and nameless rows, bounded files."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.schemas import FEED_SCHEMAS, FEEDS, KEY, STEP, with_step
from ledgerline.streaming import ledger_stream as L


def feeds(spark, rows):
    """rows: (key, step, feeds) -> the three feed frames."""
    out = {}
    for feed in FEEDS:
        names = with_step(FEED_SCHEMAS[feed]).fieldNames()
        own = [{KEY: k, STEP: s} for k, s, have in rows for f in have if f == feed[0]]
        out[feed] = spark.createDataFrame([tuple(r.get(c) for c in names) for r in own],
                                          with_step(FEED_SCHEMAS[feed]))
    return out


def give(sink, spark, batch_id, rows):
    return sink.process(L.tagged(feeds(spark, rows)), batch_id)


def told(sink):
    return sorted((r[KEY] or "", r[STEP] or 0, r["feed"][0], r["state"])
                  for r in sink.accounted().collect())


def test_matched_pending_and_late_are_all_rows(spark, scratch):
    sink = L.LedgerSink(spark, scratch, lateness=2)
    m = give(sink, spark, 0, [("a", 1, "taf"), ("b", 1, "ta"), ("c", 3, "t"), (None, 3, "taf"), ("d", None, "t")])
    assert m["rows"] == {"silver": 3, "late": 4, "pending": 3, "in": 10}
    m = give(sink, spark, 1, [("b", 1, "f"), ("c", 3, "a"), ("e", 6, "taf")])
    # b found its label before it was given up; c (3 < 6 - 2) was given up
    assert m["rows"] == {"silver": 9, "late": 6, "pending": 0, "in": 15}
    m = give(sink, spark, 2, [("c", 3, "f"), ("f", 5, "tf")])
    assert m["rows"] == {"silver": 9, "late": 7, "pending": 2, "in": 18}
    assert told(sink) == sorted(
        [(k, s, f, "matched") for k, s in (("a", 1), ("b", 1), ("e", 6)) for f in "taf"]
        + [("c", 3, f, "late") for f in "taf"] + [("f", 5, f, "pending") for f in "tf"]
        + [("", 3, f, "late") for f in "taf"] + [("d", 0, "t", "late")])
    assert sink.read(L.SILVER).count() == 3


def test_copies_of_a_key_multiply_as_in_a_join(spark, scratch):
    sink = L.LedgerSink(spark, scratch, lateness=5)
    m = give(sink, spark, 0, [("a", 1, "ttaff")] + [("h", 2, "t")] * 500 + [("h", 2, "af")])
    assert sink.read(L.SILVER).groupBy(KEY).count().collect() and m["rows"]["silver"] == 507
    assert {r[KEY]: r["count"] for r in sink.read(L.SILVER).groupBy(KEY).count().collect()} == {"a": 4, "h": 500}


def test_a_replayed_batch_adds_nothing(spark, scratch):
    sink = L.LedgerSink(spark, scratch, lateness=5)
    rows = [("a", 1, "taf"), ("b", 1, "ta")]
    first = give(sink, spark, 0, rows)
    assert give(sink, spark, 0, rows) == first == L.LedgerSink(spark, scratch, 5).manifest()
    assert sink.read(L.SILVER).count() == 1


@pytest.mark.parametrize("dies_at", ["write_batch", "_publish"])
def test_a_batch_that_died_is_done_again(spark, scratch, monkeypatch, dies_at):
    sink = L.LedgerSink(spark, scratch, lateness=5, compact_every=2)
    give(sink, spark, 0, [("a", 1, "taf"), ("b", 1, "ta")])
    before = sink.manifest()

    def die(*a, **k):
        raise OSError("killed")
    monkeypatch.setattr(L if dies_at == "write_batch" else L.LedgerSink, dies_at, die)
    with pytest.raises(OSError):
        give(sink, spark, 1, [("b", 1, "f"), ("c", 2, "taf")])
    monkeypatch.undo()
    assert sink.manifest() == before and sink.read(L.SILVER).count() == 1   # the old state, whole
    give(sink, spark, 1, [("b", 1, "f"), ("c", 2, "taf")])
    assert sorted(r[KEY] for r in sink.read(L.SILVER).collect()) == ["a", "b", "c"]
    live = {n for n in os.listdir(scratch.replace("file:", "") + "/pending")}
    assert live <= set(sink.manifest()["pending"]) | set(before["pending"])   # nothing is left behind


def test_files_of_a_step_stay_bounded(spark, scratch):
    sink = L.LedgerSink(spark, scratch, lateness=5, compact_every=3, cluster_partitions=2)
    for i in range(7):
        give(sink, spark, i, [(f"k{i}-{j}", 1 + i % 2, "taf") for j in range(4)])
        files = sink.read(L.SILVER).select(F.input_file_name().alias("f"), STEP).distinct()
        most = files.groupBy(STEP).count().agg(F.max("count")).first()[0]
        assert len(sink.manifest()["silver"]) < 3 and most <= 2 * 3
    assert sink.read(L.SILVER).count() == 28
    assert len(os.listdir(scratch.replace("file:", "") + "/manifest")) <= 2 * (L.KEPT + 1)


def test_stream_takes_each_file_once(spark, scratch):
    root, ckpt = scratch + "/bronze", scratch + "/ckpt"
    sink = L.LedgerSink(spark, scratch + "/ledger", lateness=10)

    def land(rows):
        for name, df in feeds(spark, rows).items():
            df.write.mode("append").parquet(f"{root}/{name}")
    land([("a", 1, "taf"), ("b", 2, "ta")])
    assert L.run_ledger_stream(spark, root, sink, ckpt)["rows"]["pending"] == 2
    assert L.run_ledger_stream(spark, root, sink, ckpt)["batch"] == 0       # nothing new: no batch
    land([("b", 2, "f"), ("z", 30, "t")])
    got = L.run_ledger_stream(spark, root, sink, ckpt)
    assert got["rows"] == {"silver": 6, "late": 0, "pending": 1, "in": 7}


def test_empty_ledger(spark, scratch):
    sink = L.LedgerSink(spark, scratch, lateness=1)
    assert sink.read(L.SILVER).count() == 0 and sink.accounted().count() == 0
    m = give(sink, spark, 0, [])
    assert m["rows"]["in"] == 0 and m["newest"] is None

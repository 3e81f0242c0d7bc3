"""Quality operators."""

from pyspark.sql import functions as F

from ledgerline.operators import quality


def _feeds(spark):
    tx = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 3)],
                               "transaction_id string, step int")
    acct = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "transaction_id string, step int")
    fraud = spark.createDataFrame([("a", 1), ("a", 1), ("c", 2), ("x", 2)],
                                  "transaction_id string, step int")
    return {"transactions": tx, "accounts": acct, "fraud": fraud}


def test_unmatched_keys(spark):
    got = {tuple(r) for r in quality.unmatched_keys(_feeds(spark)).collect()}
    assert got == {("b", 1, "fraud"), ("d", 3, "accounts"), ("d", 3, "fraud"),
                   ("x", 2, "transactions"), ("x", 2, "accounts")}


def test_duplicate_keys(spark):
    got = [tuple(r) for r in quality.duplicate_keys(_feeds(spark)).collect()]
    assert got == [("fraud", "a", 1, 2)]


def test_feed_completeness(spark):
    expected = spark.createDataFrame([(1,), (2,), (3,), (4,)], "step int")
    got = {r["step"]: tuple(r)[1:] for r in
           quality.feed_completeness(_feeds(spark), expected).collect()}
    assert got[1] == (True, True, True, True)
    assert got[3] == (True, False, False, False)
    assert got[4] == (False, False, False, False)


def test_reconcile(spark):
    raw = spark.createDataFrame([(1,), (1,), (2,), (None,)], "step int")
    feeds = {"transactions": raw.filter("step is not null"), "fraud": raw}
    got = {r["feed"]: r for r in quality.reconcile(raw, feeds).collect()}
    assert got["transactions"]["rows_out"] == 3 and got["transactions"]["missing"] == 1
    assert got["fraud"]["batches"] == 2 and not got["fraud"]["ok"]


def test_corrupt_rate_and_rows(spark):
    df = spark.createDataFrame([("A", True), ("A", False), ("A", None), ("B", False)],
                               "type string, is_corrupt boolean")
    got = {r["type"]: tuple(r)[1:] for r in quality.corrupt_rate(df).collect()}
    assert got == {"A": (2, 1, 0.5), "B": (1, 0, 0.0)}
    assert quality.corrupt_rows(df).count() == 1


def test_expired_is_strict(spark):
    df = spark.createDataFrame([("2025-01-12 23:59:59",), ("2025-01-13 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = quality.expired(df, "t", "2025-01-20 00:00:00", 7).collect()
    assert len(got) == 1


def test_describe_schema_and_preview(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, s string")
    sch = [tuple(r) for r in quality.describe_schema(df).collect()]
    assert sch == [(1, "id", "int", True), (2, "s", "string", True)]
    assert [r["id"] for r in quality.preview(df, 2, ["id"]).collect()] == [1, 2]
    assert quality.row_count(df).collect()[0]["rows"] == 3

"""Gold tables on hand-made silver rows."""

import datetime as dt

from ledgerline.operators.gold import (
    hourly_fraud_metrics, system_audit, transaction_trends, victim_profile)

SCHEMA = ("transaction_id string, type string, amount double, oldbalanceOrg double, "
          "newbalanceOrig double, isFraud int, isFlaggedFraud int, transaction_time timestamp_ntz")


def _silver(spark):
    t = dt.datetime(2025, 1, 1, 1, 5)
    rows = [
        ("a", "CASH", 10.1, 100.0, 89.9, 1, 1, t),
        ("b", "CASH", 20.2, 50.0, 29.8, 1, 0, t + dt.timedelta(minutes=30)),
        ("c", "CASH", 30.3, 10.0, 0.0, 0, 1, t + dt.timedelta(hours=1)),
        ("d", "XFER", 0.1, 5.0, 4.9, 0, 0, t),
        ("e", "XFER", 0.2, 5.0, 4.8, None, 1, t),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_system_audit(spark):
    got = {r["type"]: tuple(r)[1:] for r in system_audit(_silver(spark)).collect()}
    assert got["CASH"] == (1, 1, 1)
    # NULL label contributes NULL, ignored by sum
    assert got["XFER"] == (0, 0, 0)


def test_hourly_grain_and_exact(spark):
    s = _silver(spark)
    hour = {(r["transaction_time"], r["type"]): r for r in hourly_fraud_metrics(s).collect()}
    h1 = dt.datetime(2025, 1, 1, 1)
    assert hour[(h1, "CASH")]["total_transactions"] == 2
    assert hour[(h1, "CASH")]["fraud_cases"] == 2
    assert hour[(h1, "CASH")]["total_money_moved"] == 30.3
    assert hour[(h1, "CASH")]["average_txn_amount"] == 15.15
    assert hour[(h1, "XFER")]["total_money_moved"] == 0.3      # exact, not 0.30000000000000004
    assert hourly_fraud_metrics(s, "exact").count() == 4
    ordered = [r["transaction_time"] for r in hourly_fraud_metrics(s, ordered=True).collect()]
    assert ordered == sorted(ordered)


def test_money_sums_layout_invariant(spark):
    s = _silver(spark)
    a = hourly_fraud_metrics(s.repartition(1)).collect()
    b = hourly_fraud_metrics(s.repartition(5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_victim_profile_null_label_group(spark):
    got = {(r["type"], r["isFraud"]): r for r in victim_profile(_silver(spark)).collect()}
    assert set(got) == {("CASH", 1), ("CASH", 0), ("XFER", 0), ("XFER", None)}
    assert got[("CASH", 1)]["avg_victim_balance"] == 75.0
    assert got[("CASH", 1)]["total_count"] == 2


def test_trends_status_and_math_error(spark):
    got = {r["status"] for r in transaction_trends(_silver(spark)).collect()}
    assert got == {"FRAUD", "LEGIT"}
    rows = transaction_trends(_silver(spark)).collect()
    assert transaction_trends(_silver(spark)).columns == [
        "transaction_time", "type", "amount", "oldbalanceOrg", "newbalanceOrig",
        "status", "math_error"]
    c = [r for r in rows if r["amount"] == 30.3][0]
    assert c["math_error"] == (10.0 - 30.3) - 0.0


def test_victim_profile_ordered(spark):
    rows = victim_profile(_silver(spark), ordered=True).collect()
    keys = [(r["type"], -1 if r["isFraud"] is None else r["isFraud"]) for r in rows]
    assert keys == sorted(keys)


def test_one_pass_equals_separate_tables(spark):
    from ledgerline.operators.gold import gold_aggregates_one_pass
    s = _silver(spark)
    one = gold_aggregates_one_pass(s)
    for name, sep in (("HOURLY_FRAUD_METRICS", hourly_fraud_metrics(s)),
                      ("VICTIM_PROFILE", victim_profile(s)),
                      ("SYSTEM_AUDIT", system_audit(s))):
        got = one[name]
        assert got.columns == sep.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, sep.collect()), key=repr)

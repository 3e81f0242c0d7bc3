"""Every registered query against its DuckDB oracle at sf0.001, plus plan checks."""

import math

import duckdb
import pytest

import __spark_entry__ as se

from ledgerline.plans.registry import QUERIES as REFERENCE_QUERIES

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(rows):
    def n(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF001)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PAIR_NODES), "no query may pair rows up"
    if name in REFERENCE_QUERIES:
        assert not any(n in plan for n in PY_NODES), "the reference's operators stay in the JVM"
    sql = se.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    perm = [df.columns.index(c) for c in ocols]
    assert _norm(tuple(r[i] for i in perm) for r in rows) == _norm(res.fetchall())


def test_entry_runs(spark):
    assert se.entry(spark).count() > 0


PURE = ["transaction_ids", "silver_enriched", "hourly_fraud_metrics", "victim_profile",
        "system_audit", "trends_detailed", "unmatched_rows", "duplicate_keys",
        "feed_completeness", "corrupt_rate", "hourly_fraud_metrics_ordered",
        "victim_profile_ordered", "hourly_fraud_metrics_one_pass", "corrupt_rows",
        "retention_expired", "step_counts"]


@pytest.mark.parametrize("name", PURE)
def test_plans_stay_in_the_jvm(spark, name):
    plan = se.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_NODES)


def test_gold_aggregates_are_partial_then_final(spark):
    plan = se.queries()["system_audit"](spark, SF001)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("HashAggregate") >= 2

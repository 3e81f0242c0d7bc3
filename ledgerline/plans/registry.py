"""Named queries over the generated test tables, with DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and processes every row of
the tables it reads. ``ORACLES`` holds, per name, SQL that DuckDB runs on the
same parquet files; names without an oracle get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import gold, quality, silver, split
from ledgerline.plans import gold_job, profile_job, silver_job, split_job
from ledgerline.schemas import FEEDS, SILVER_COLUMNS, STEP
from ledgerline.session import scratch_path
from ledgerline.sinks import writers
from ledgerline.sources import feeds as feed_src
from ledgerline.sources import files as file_src
from ledgerline.sources.sample import sample_customers
from ledgerline.streaming import silver_stream as stream
from ledgerline.testdata import mapping
from ledgerline.testdata import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Files of a feed in one micro-batch of the bounded stream.
STREAM_FILES = 300


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver(*mapping.feeds(spark, sf_dir))


# ---------------------------------------------------------------- split side

@register("transaction_ids", O.with_ctes(O.RAW_CTE) + """
SELECT step, type, amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
       "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
       concat('TXN-', step, '-', row_number() OVER (
         PARTITION BY step ORDER BY type, amount, "nameOrig", "oldbalanceOrg",
           "newbalanceOrig", "nameDest", "oldbalanceDest", "newbalanceDest",
           "isFraud", "isFlaggedFraud") - 1) AS transaction_id
FROM raw""")
def q_transaction_ids(spark, sf_dir):
    return split.with_transaction_id(mapping.raw_table(spark, sf_dir))


@register("raw_scan", O.with_ctes(O.RAW_CTE) + """
SELECT step, type, amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
       "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud" FROM raw""")
def q_raw_scan(spark, sf_dir):
    """The wide raw table as a headed CSV, read back with the explicit schema."""
    path = scratch_path(spark, "raw_csv")
    writers.write_any(mapping.raw_table(spark, sf_dir), path, "csv")
    return feed_src.read_raw(spark, path)


@register("split_transactions", O.BASE + """
SELECT transaction_id, step, type, amount, origin_account_id, dest_account_id FROM tx""")
def q_split_transactions(spark, sf_dir):
    return mapping.feeds(spark, sf_dir)[0]


@register("split_accounts", O.BASE + """
SELECT transaction_id, "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", step
FROM acct""")
def q_split_accounts(spark, sf_dir):
    return mapping.feeds(spark, sf_dir)[1]


@register("split_labels", O.BASE + """
SELECT transaction_id, "isFraud", "isFlaggedFraud", step FROM fraud""")
def q_split_labels(spark, sf_dir):
    return mapping.feeds(spark, sf_dir)[2]


@register("step_counts", O.with_ctes(O.RAW_CTE) + """
SELECT step, count(*) AS rows FROM raw GROUP BY step""")
def q_step_counts(spark, sf_dir):
    return split.step_counts(mapping.raw_table(spark, sf_dir))


# --------------------------------------------------------------- silver side

@register("silver_join", O.SILVER + """
SELECT transaction_id, step, type, amount, origin_account_id, dest_account_id,
       "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
       "isFraud", "isFlaggedFraud" FROM silver""")
def q_silver_join(spark, sf_dir):
    return silver.join_feeds(*mapping.feeds(spark, sf_dir))


@register("silver_enriched", O.SILVER + "SELECT * FROM silver")
def q_silver_enriched(spark, sf_dir):
    return _silver(spark, sf_dir)


# ----------------------------------------------------------------- gold side

_HOUR_KEY = "timestamp '2025-01-01 00:00:00' + to_hours(step)"

@register("hourly_fraud_metrics", O.SILVER + f"""
SELECT {_HOUR_KEY} AS transaction_time, type,
       count(transaction_id) AS total_transactions,
       cast(sum("isFraud") AS BIGINT) AS fraud_cases,
       {O.money_sum('amount')} AS total_money_moved,
       {O.money_avg('amount')} AS average_txn_amount
FROM silver GROUP BY 1, 2""")
def q_hourly_fraud_metrics(spark, sf_dir):
    return gold.hourly_fraud_metrics(_silver(spark, sf_dir), "hour")


@register("hourly_fraud_metrics_exact", O.SILVER + f"""
SELECT transaction_time, type,
       count(transaction_id) AS total_transactions,
       cast(sum("isFraud") AS BIGINT) AS fraud_cases,
       {O.money_sum('amount')} AS total_money_moved,
       {O.money_avg('amount')} AS average_txn_amount
FROM silver GROUP BY 1, 2""")
def q_hourly_fraud_metrics_exact(spark, sf_dir):
    return gold.hourly_fraud_metrics(_silver(spark, sf_dir), "exact")


@register("hourly_fraud_metrics_ordered", ORACLES["hourly_fraud_metrics"]
          + " ORDER BY transaction_time")
def q_hourly_fraud_metrics_ordered(spark, sf_dir):
    return gold.hourly_fraud_metrics(_silver(spark, sf_dir), "hour", ordered=True)


@register("victim_profile", O.SILVER + f"""
SELECT type, "isFraud", count(transaction_id) AS total_count,
       {O.money_avg('"oldbalanceOrg"')} AS avg_victim_balance,
       {O.money_avg('amount')} AS avg_transaction_size
FROM silver GROUP BY 1, 2""")
def q_victim_profile(spark, sf_dir):
    return gold.victim_profile(_silver(spark, sf_dir))


@register("victim_profile_ordered", ORACLES["victim_profile"] + " ORDER BY 1, 2")
def q_victim_profile_ordered(spark, sf_dir):
    return gold.victim_profile(_silver(spark, sf_dir), ordered=True)


@register("system_audit", O.SILVER + """
SELECT type,
       cast(sum("isFraud" * (1 - "isFlaggedFraud")) AS BIGINT) AS missed_fraud,
       cast(sum("isFraud" * "isFlaggedFraud") AS BIGINT) AS caught_fraud,
       cast(sum((1 - "isFraud") * "isFlaggedFraud") AS BIGINT) AS false_alarms
FROM silver GROUP BY 1""")
def q_system_audit(spark, sf_dir):
    return gold.system_audit(_silver(spark, sf_dir))


@register("trends_detailed", O.SILVER + """
SELECT transaction_time, type, amount, "oldbalanceOrg", "newbalanceOrig",
       CASE WHEN "isFraud" = 1 THEN 'FRAUD' ELSE 'LEGIT' END AS status,
       ("oldbalanceOrg" - amount) - "newbalanceOrig" AS math_error
FROM silver""")
def q_trends_detailed(spark, sf_dir):
    return gold.transaction_trends(_silver(spark, sf_dir))


# ------------------------------------------------------------ quality checks


FIXED_PROCESSED_AT = "2025-01-01 00:00:00"   # fixed job time for repeatable output
RETENTION_AS_OF = "2025-01-20 00:00:00"
BATCH_DAY = list(range(1, 25))                # steps 1..24: the first day


def _faulty(spark, sf_dir):
    return dict(zip(FEEDS, mapping.feeds(spark, sf_dir, faulty=True)))


_PRESENCE = O.FAULTY + """, keys AS (
  SELECT transaction_id, step, 'transactions' AS feed FROM tx
  UNION ALL SELECT transaction_id, step, 'accounts' FROM acct_f
  UNION ALL SELECT transaction_id, step, 'fraud' FROM fraud_f
), pres AS (
  SELECT transaction_id, step,
         count(*) FILTER (WHERE feed = 'transactions') AS n_transactions,
         count(*) FILTER (WHERE feed = 'accounts') AS n_accounts,
         count(*) FILTER (WHERE feed = 'fraud') AS n_fraud
  FROM keys GROUP BY 1, 2
)
"""


@register("unmatched_rows", _PRESENCE + """
SELECT transaction_id, step, 'transactions' AS missing_feed FROM pres WHERE n_transactions = 0
UNION ALL SELECT transaction_id, step, 'accounts' FROM pres WHERE n_accounts = 0
UNION ALL SELECT transaction_id, step, 'fraud' FROM pres WHERE n_fraud = 0""")
def q_unmatched_rows(spark, sf_dir):
    return quality.unmatched_keys(_faulty(spark, sf_dir))


@register("duplicate_keys", _PRESENCE + """
SELECT 'transactions' AS feed, transaction_id, step, n_transactions AS copies FROM pres WHERE n_transactions > 1
UNION ALL SELECT 'accounts', transaction_id, step, n_accounts FROM pres WHERE n_accounts > 1
UNION ALL SELECT 'fraud', transaction_id, step, n_fraud FROM pres WHERE n_fraud > 1""")
def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_faulty(spark, sf_dir))


@register("feed_completeness", O.FAULTY + """, steps AS (
  SELECT step, 1 AS f FROM tx UNION ALL SELECT step, 2 FROM acct_f UNION ALL SELECT step, 4 FROM fraud_f
)
SELECT step, bool_or(f = 1) AS has_transactions, bool_or(f = 2) AS has_accounts,
       bool_or(f = 4) AS has_fraud,
       bool_or(f = 1) AND bool_or(f = 2) AND bool_or(f = 4) AS complete
FROM steps GROUP BY step""")
def q_feed_completeness(spark, sf_dir):
    return quality.feed_completeness(_faulty(spark, sf_dir))


@register("split_reconcile", O.with_ctes(O.RAW_CTE) + """
SELECT f.feed, n.rows_in, n.rows_in AS rows_out, cast(0 AS BIGINT) AS missing,
       n.batches, true AS ok
FROM (VALUES ('transactions'), ('accounts'), ('fraud')) f(feed),
     (SELECT count(*) AS rows_in, count(DISTINCT step) AS batches FROM raw) n""")
def q_split_reconcile(spark, sf_dir):
    out = scratch_path(spark, "split")
    return split_job.run_split(spark, mapping.raw_table(spark, sf_dir), out)


# ----------------------------------------------------- quality flag queries

@register("corrupt_rows", O.SILVER + "SELECT * FROM silver WHERE is_corrupt")
def q_corrupt_rows(spark, sf_dir):
    return quality.corrupt_rows(_silver(spark, sf_dir))


@register("corrupt_rate", O.SILVER + """
SELECT type, count(is_corrupt) AS rows, count(*) FILTER (WHERE is_corrupt) AS corrupt_rows,
       cast(count(*) FILTER (WHERE is_corrupt) AS DOUBLE) / count(is_corrupt) AS corrupt_rate
FROM silver GROUP BY type""")
def q_corrupt_rate(spark, sf_dir):
    return quality.corrupt_rate(_silver(spark, sf_dir))


@register("retention_expired", O.SILVER + f"""
SELECT * FROM silver
WHERE transaction_time < timestamp '{RETENTION_AS_OF}' - INTERVAL 7 DAY""")
def q_retention_expired(spark, sf_dir):
    return quality.expired(_silver(spark, sf_dir), "transaction_time", RETENTION_AS_OF, 7)


# ------------------------------------------- bronze files, silver table I/O

def _bronze(spark, sf_dir, fmt="csv") -> str:
    root = scratch_path(spark, "bronze")
    split_job.write_split_feeds(spark, mapping.raw_with_ids(spark, sf_dir), root, fmt)
    return root


def _silver_table(spark, sf_dir, mode="replace", times=1) -> str:
    bronze = _bronze(spark, sf_dir)
    path = scratch_path(spark, "silver")
    for _ in range(times):
        silver_job.run_silver(spark, bronze, path, mode=mode)
    return path


def _read_silver(spark, path):
    return file_src.read_table(spark, path).select(*SILVER_COLUMNS)


@register("feed_scan", O.BASE + """
SELECT transaction_id, step, type, amount, origin_account_id, dest_account_id FROM tx""")
def q_feed_scan(spark, sf_dir):
    return feed_src.read_feed(spark, _bronze(spark, sf_dir), "transactions")


@register("batch_select", O.SILVER + f"""
SELECT * FROM silver WHERE step BETWEEN {BATCH_DAY[0]} AND {BATCH_DAY[-1]}""")
def q_batch_select(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    path = scratch_path(spark, "silver")
    silver_job.run_silver(spark, bronze, path, steps=BATCH_DAY)
    return _read_silver(spark, path)


@register("bronze_landing", O.BASE + """
SELECT 'transactions' AS feed, step, count(*) AS rows FROM tx GROUP BY step
UNION ALL SELECT 'accounts', step, count(*) FROM acct GROUP BY step
UNION ALL SELECT 'fraud', step, count(*) FROM fraud GROUP BY step""")
def q_bronze_landing(spark, sf_dir):
    src = _bronze(spark, sf_dir)
    dst = scratch_path(spark, "landed")
    feeds = {f: feed_src.read_feed(spark, src, f, with_source_file=True) for f in FEEDS}
    writers.land_batch(spark, feeds, dst)
    out = None
    for f in FEEDS:
        part = (feed_src.read_feed(spark, dst, f, fmt="parquet").groupBy(STEP)
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(f).alias("feed"), STEP, "rows"))
        out = part if out is None else out.unionByName(part)
    return out


@register("silver_scan", O.SILVER + "SELECT * FROM silver")
def q_silver_scan(spark, sf_dir):
    return _read_silver(spark, _silver_table(spark, sf_dir))


@register("silver_append", O.SILVER + "SELECT * FROM silver UNION ALL SELECT * FROM silver")
def q_silver_append(spark, sf_dir):
    return _read_silver(spark, _silver_table(spark, sf_dir, "append", times=2))


@register("silver_replace", O.SILVER + "SELECT * FROM silver")
def q_silver_replace(spark, sf_dir):
    return _read_silver(spark, _silver_table(spark, sf_dir, "replace", times=2))


@register("silver_count", O.SILVER + "SELECT count(*) AS rows FROM silver")
def q_silver_count(spark, sf_dir):
    return quality.row_count(_read_silver(spark, _silver_table(spark, sf_dir)))


@register("silver_preview", O.SILVER + "SELECT * FROM silver ORDER BY transaction_id LIMIT 20")
def q_silver_preview(spark, sf_dir):
    return quality.preview(_read_silver(spark, _silver_table(spark, sf_dir)), 20,
                           by=["transaction_id"])


_SILVER_TYPES = [("transaction_id", "string"), ("step", "int"), ("type", "string"),
                 ("amount", "double"), ("origin_account_id", "string"),
                 ("dest_account_id", "string"), ("oldbalanceOrg", "double"),
                 ("newbalanceOrig", "double"), ("oldbalanceDest", "double"),
                 ("newbalanceDest", "double"), ("isFraud", "int"),
                 ("isFlaggedFraud", "int"), ("transaction_time", "timestamp_ntz"),
                 ("is_corrupt", "boolean")]


@register("silver_schema", "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, '{n}', '{t}', true)" for i, (n, t) in enumerate(_SILVER_TYPES))
    + ") v(position, name, type, nullable)")
def q_silver_schema(spark, sf_dir):
    return quality.describe_schema(_read_silver(spark, _silver_table(spark, sf_dir)))


# ------------------------------------------------------------- gold refresh

# per published table: a whole-number measure that adds up over its rows
_GOLD_MEASURES = {
    "HOURLY_FRAUD_METRICS": ("total_transactions", "hourly_fraud_metrics"),
    "VICTIM_PROFILE": ("total_count", "victim_profile"),
    "SYSTEM_AUDIT": ("missed_fraud + caught_fraud + false_alarms", "system_audit"),
    "TRANSACTION_TRENDS_DETAILED": ("1", "trends_detailed"),
}


@register("gold_refresh", "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, count(*) AS rows, "
    f"cast(sum({measure}) AS BIGINT) AS covered FROM ({ORACLES[query]}) q"
    for table, (measure, query) in _GOLD_MEASURES.items()))
def q_gold_refresh(spark, sf_dir):
    """The gold job end to end: stored silver -> four tables published as
    files -> read back; one row per table with its size and covered rows."""
    root = scratch_path(spark, "gold")
    gold_job.run_gold(spark, _silver_table(spark, sf_dir), gold_job.to_files(root))
    out = None
    for table, (measure, _) in _GOLD_MEASURES.items():
        part = file_src.read_table(spark, f"{root}/{table}").agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.sum(F.expr(measure)).cast("bigint").alias("covered"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------- generic profile job

# The sample's cities, categories and formulas, and the job's name below.
_SAMPLE_SQL = """
-- the generator's modulo is a floor modulo (ids may start at 0)
SELECT c_custkey AS id, concat('Customer_', c_custkey) AS name,
       cast(20 + (((c_custkey - 1) % 50) + 50) % 50 AS INTEGER) AS age,
       ['New York', 'Los Angeles', 'Chicago', 'Houston', 'Phoenix'][((((c_custkey - 1) % 5) + 5) % 5) + 1] AS city,
       100.0::DOUBLE + cast(c_custkey - 1 AS DOUBLE) * 10.5 AS purchase_amount,
       strftime(DATE '2024-01-01' + cast(c_custkey - 1 AS INTEGER), '%Y-%m-%d') AS purchase_date,
       ['Electronics', 'Clothing', 'Food', 'Books', 'Sports'][((((c_custkey - 1) % 5) + 5) % 5) + 1] AS category,
       cast(70 + (((c_custkey - 1) % 30) + 30) % 30 AS INTEGER) AS score
FROM customer"""


def _customer_ids(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("id"))


@register("sample_customers", _SAMPLE_SQL)
def q_sample_customers(spark, sf_dir):
    return sample_customers(_customer_ids(spark, sf_dir))


def _sample_csv(spark, sf_dir, one_file: bool = False) -> str:
    path = scratch_path(spark, "sample_csv")
    sample = sample_customers(_customer_ids(spark, sf_dir))
    writers.write_any(sample.orderBy("id") if one_file else sample, path, "csv",
                      files=1 if one_file else None)
    return path


@register("profile_csv", f"""
WITH s AS ({_SAMPLE_SQL})
SELECT cast(id AS INTEGER) AS id, name, age, city, purchase_amount,
       cast(purchase_date AS DATE) AS purchase_date, category, score,
       timestamp '{FIXED_PROCESSED_AT}' AS processed_timestamp,
       'spark_airflow_job' AS processing_job, cast(id AS BIGINT) * 2 AS row_id,
       upper(name) AS name_upper, upper(city) AS city_upper, upper(category) AS category_upper
FROM s""")
def q_profile_csv(spark, sf_dir):
    return profile_job.profile_frame(spark, _sample_csv(spark, sf_dir), "csv",
                                     FIXED_PROCESSED_AT)


@register("profile_json", O.BASE + f"""
SELECT transaction_id, cast(step AS BIGINT) AS step, type, amount, origin_account_id,
       dest_account_id, timestamp '{FIXED_PROCESSED_AT}' AS processed_timestamp,
       'spark_airflow_job' AS processing_job, count(*) OVER () AS record_count
FROM tx""")
def q_profile_json(spark, sf_dir):
    path = scratch_path(spark, "tx_json")
    tx = mapping.feeds(spark, sf_dir)[0]
    writers.write_any(tx, path, "json")
    return profile_job.profile_frame(spark, path, "json", FIXED_PROCESSED_AT)


def _profiled_output(spark, sf_dir) -> str:
    """The profile job's output as one file, in order of the id."""
    out = scratch_path(spark, "profiled")
    profile_job.run_profile(spark, _sample_csv(spark, sf_dir, one_file=True), out, "csv",
                            FIXED_PROCESSED_AT, files=1)
    return out


@register("output_inventory")
def q_output_inventory(spark, sf_dir):
    out = _profiled_output(spark, sf_dir)
    inv = file_src.file_inventory(spark, out)
    return file_src.inventory_summary(inv.filter(F.col("file_path").endswith(".csv")))


@register("output_preview")
def q_output_preview(spark, sf_dir):
    return file_src.first_lines(spark, _profiled_output(spark, sf_dir), 5)


# ---------------------------------------------------------------- streaming

@register("silver_stream", O.SILVER + "SELECT * FROM silver")
def q_silver_stream(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, fmt="parquet")
    sink = scratch_path(spark, "silver_stream")
    ckpt = scratch_path(spark, "silver_stream_ckpt")
    stream.run_silver_stream_once(spark, bronze, sink, ckpt, fmt="parquet",
                                  watermark="2 hours",
                                  state_partitions=spark.sparkContext.defaultParallelism,
                                  count_state=False)
    return _read_silver(spark, sink)


@register("silver_stream_bounded", O.SILVER + "SELECT * FROM silver")
def q_silver_stream_bounded(spark, sf_dir):
    """Several micro-batches, no watermark: state waits for the files still to come."""
    bronze = _bronze(spark, sf_dir, fmt="parquet")
    sink = scratch_path(spark, "silver_stream")
    ckpt = scratch_path(spark, "silver_stream_ckpt")
    stream.run_silver_stream_once(spark, bronze, sink, ckpt, fmt="parquet",
                                  state_partitions=spark.sparkContext.defaultParallelism,
                                  max_files_per_trigger=STREAM_FILES, count_state=False)
    return _read_silver(spark, sink)


# ------------------------------------------------- single-pass gold variant

def _one_pass(spark, sf_dir, table):
    return gold.gold_aggregates_one_pass(_silver(spark, sf_dir))[table]


@register("hourly_fraud_metrics_one_pass", ORACLES["hourly_fraud_metrics"])
def q_hourly_one_pass(spark, sf_dir):
    return _one_pass(spark, sf_dir, "HOURLY_FRAUD_METRICS")


@register("victim_profile_one_pass", ORACLES["victim_profile"])
def q_victim_one_pass(spark, sf_dir):
    return _one_pass(spark, sf_dir, "VICTIM_PROFILE")


@register("system_audit_one_pass", ORACLES["system_audit"])
def q_audit_one_pass(spark, sf_dir):
    return _one_pass(spark, sf_dir, "SYSTEM_AUDIT")


# further queries register themselves on import
from ledgerline.plans import registry_delivery  # noqa: E402, F401

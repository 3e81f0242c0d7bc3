"""Queries over delivered files: bronze as text, values that do not fit, replaced steps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import drift, split, verify
from ledgerline.operators.gold import GOLD_TABLES
from ledgerline.operators.profile import audit_columns
from ledgerline.operators.silver import build_silver
from ledgerline.plans import gold_job, silver_job, split_job
from ledgerline.plans.registry import (
    FIXED_PROCESSED_AT, ORACLES, RETENTION_AS_OF, _bronze, _GOLD_MEASURES, _profiled_output, register)
from ledgerline.schemas import FEED_SCHEMAS, FEEDS, RAW_SCHEMA, SILVER_COLUMNS, STEP
from ledgerline.session import scratch_path
from ledgerline.sinks import bronze, warehouse, writers
from ledgerline.sinks import steps as step_sink
from ledgerline.sources import delivered
from ledgerline.sources.json_lines import read_json_lines
from ledgerline.streaming import ledger_stream
from ledgerline.testdata import mapping
from ledgerline.testdata import oracle as O

#: Injected faults, by event_id (fixed rules, the same in the oracles below).
BAD_AMOUNT, BAD_FLAG, BAD_STEP, NO_RECORD = 211, 223, 227, 229
RAW_WITH_EVENT = T.StructType([*RAW_SCHEMA.fields, T.StructField("event_id", T.LongType())])


def _delivered_raw(spark, sf_dir) -> str:
    """The wide table as CSV files: two column orders, values that do not fit, lines that are no record."""
    raw, eid = mapping.raw_events(spark, sf_dir), F.col("event_id")
    text = {c: F.col(c).cast("string") for c in RAW_WITH_EVENT.fieldNames()}
    text["amount"] = F.when(eid % BAD_AMOUNT == 0, "n/a").otherwise(text["amount"])
    text["isFraud"] = F.when(eid % BAD_FLAG == 0, "yes").otherwise(text["isFraud"])
    text["step"] = F.when(eid % BAD_STEP == 0, F.concat(text["step"], F.lit("x"))).otherwise(text["step"])
    names = RAW_WITH_EVENT.fieldNames()
    root = scratch_path(spark, "delivered_raw")
    records = raw.where(eid % NO_RECORD != 0)
    for folder, part, order in (("even", records.where(eid % 2 == 0), names),
                                ("odd", records.where(eid % 2 != 0), names[::-1])):
        part.select(*[text[c].alias(c) for c in order]).write.option("header", True).csv(f"{root}/{folder}")
    raw.where(eid % NO_RECORD == 0).select(F.concat(F.lit("cut off,"), eid.cast("string"))) \
        .write.text(f"{root}/torn")
    return root


def _rescued(spark, sf_dir):
    lines = delivered.read_lines(spark, _delivered_raw(spark, sf_dir), recursive=True)
    return delivered.rescue(lines, RAW_WITH_EVENT)


@register("malformed_values", O.with_ctes(O.RAW_CTE) + f"""
SELECT event_id, 'amount' AS field, 'n/a' AS value FROM raw
WHERE event_id % {BAD_AMOUNT} = 0 AND event_id % {NO_RECORD} <> 0
UNION ALL SELECT event_id, 'isFraud', 'yes' FROM raw
WHERE event_id % {BAD_FLAG} = 0 AND event_id % {NO_RECORD} <> 0
UNION ALL SELECT event_id, 'step', step || 'x' FROM raw
WHERE event_id % {BAD_STEP} = 0 AND event_id % {NO_RECORD} <> 0
UNION ALL SELECT NULL, NULL, 'cut off,' || event_id FROM raw WHERE event_id % {NO_RECORD} = 0""")
def q_malformed_values(spark, sf_dir):
    return bronze.malformed_values(_rescued(spark, sf_dir), ["event_id"])


@register("rescued_rows", O.with_ctes(O.RAW_CTE) + f"""
SELECT step, type, amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
       "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud", event_id FROM raw
WHERE event_id % {BAD_AMOUNT} <> 0 AND event_id % {BAD_FLAG} <> 0
  AND event_id % {BAD_STEP} <> 0 AND event_id % {NO_RECORD} <> 0""")
def q_rescued_rows(spark, sf_dir):
    return delivered.sound(_rescued(spark, sf_dir)).select(*RAW_WITH_EVENT.fieldNames())


@register("bronze_as_delivered", O.BASE + """
SELECT 'transactions' AS feed, transaction_id, step, type, amount, origin_account_id, dest_account_id,
       NULL::DOUBLE AS "oldbalanceOrg", NULL::DOUBLE AS "newbalanceOrig", NULL::DOUBLE AS "oldbalanceDest",
       NULL::DOUBLE AS "newbalanceDest", NULL::INTEGER AS "isFraud", NULL::INTEGER AS "isFlaggedFraud" FROM tx
UNION ALL SELECT 'accounts', transaction_id, step, NULL, NULL, NULL, NULL, "oldbalanceOrg",
       "newbalanceOrig", "oldbalanceDest", "newbalanceDest", NULL, NULL FROM acct
UNION ALL SELECT 'fraud', transaction_id, step, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       "isFraud", "isFlaggedFraud" FROM fraud""")
def q_bronze_as_delivered(spark, sf_dir):
    """Feed files landed as text, read back through the typed view: every value of every row."""
    landed = scratch_path(spark, "bronze_text")
    bronze.land_files(spark, _bronze(spark, sf_dir), landed, load_id="first")
    out = None
    for feed in FEEDS:
        part = bronze.typed_feed(spark, landed, feed).withColumn("feed", F.lit(feed))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = ["step"] + [c for f in FEEDS for c in FEED_SCHEMAS[f].fieldNames() if c != "transaction_id"]
    return out.select("feed", "transaction_id", *dict.fromkeys(names))


#: Steps delivered a second time, with faults; the fraud feed of one is empty then.
AGAIN = [4, mapping.INCOMPLETE_STEP, 6]


@register("silver_replace_steps", O.SILVER + f""", again AS (
  SELECT {O.SILVER_SELECT} FROM tx
  JOIN (SELECT * FROM acct WHERE event_id % 101 <> 0) a ON tx.transaction_id = a.transaction_id AND tx.step = a.step
  JOIN (SELECT * FROM fraud WHERE event_id % 103 <> 0 AND step <> {mapping.INCOMPLETE_STEP}) f
    ON tx.transaction_id = f.transaction_id AND tx.step = f.step
)
SELECT * FROM silver WHERE step NOT IN ({", ".join(map(str, AGAIN))})
UNION ALL
SELECT * FROM silver WHERE step IN ({", ".join(map(str, AGAIN))})
  AND transaction_id IN (SELECT transaction_id FROM again)""")
def q_silver_replace_steps(spark, sf_dir):
    """All steps, then three of them again from a faulty delivery: one of these ends up empty."""
    path = scratch_path(spark, "silver")
    silver_job.run_silver(spark, _bronze(spark, sf_dir), path)
    tx, acct, fraud = mapping.feeds(spark, sf_dir, faulty=True)
    faulty = scratch_path(spark, "bronze_again")
    feeds = {"transactions": tx, "accounts": acct, "fraud": fraud.distinct()}
    writers.write_feeds({n: d.where(F.col(STEP).isin(AGAIN)) for n, d in feeds.items()}, faulty)
    silver_job.run_silver(spark, faulty, path, steps=AGAIN)
    return step_sink.read_steps(spark, path).select(*SILVER_COLUMNS)


@register("global_row_index", O.with_ctes(O.RAW_CTE) + """
SELECT 'TXN-' || step || '-' || (row_number() OVER (ORDER BY event_id) - 1) AS transaction_id,
       row_number() OVER (ORDER BY event_id) - 1 AS line_index, event_id, step, type, amount FROM raw""")
def q_global_row_index(spark, sf_dir):
    """Ids numbered over all input files in input order, from files of unequal size."""
    raw, eid = mapping.raw_events(spark, sf_dir), F.col("event_id")
    root = scratch_path(spark, "ordered_raw")
    cuts = [("a", eid < 100), ("b", (eid >= 100) & (eid < 700)), ("c", eid >= 700)]
    for name, rows in cuts:
        part = raw.where(rows).select(*RAW_WITH_EVENT.fieldNames())
        part.repartitionByRange(3, "event_id").sortWithinPartitions("event_id") \
            .write.option("header", True).csv(f"{root}/{name}")
    indexed = split_job.with_input_index(spark, root, RAW_WITH_EVENT)
    return indexed.select("transaction_id", "line_index", "event_id", "step", "type", "amount")


# ------------------------------------------- streaming with every row accounted for

#: Deliveries end at these steps; a label of every 103rd event comes one delivery late.
DELIVERY_ENDS, LATENESS = (240, 480), 48

_ACCOUNTS = O.BASE + f""", h AS (
  SELECT max(step) FILTER (step <= {DELIVERY_ENDS[0]}) - {LATENESS} AS h1,
         max(step) FILTER (step <= {DELIVERY_ENDS[1]}) - {LATENESS} AS h2,
         max(step) - {LATENESS} AS h3 FROM rawid
), told AS (
  SELECT transaction_id, step, event_id % 101 = 0 AS lost,
    CASE WHEN event_id % 101 <> 0 AND (event_id % 103 <> 0 OR step >= CASE
           WHEN step <= {DELIVERY_ENDS[0]} THEN h1 WHEN step <= {DELIVERY_ENDS[1]} THEN h2 ELSE h3 END)
         THEN 'matched' WHEN step >= h3 THEN 'pending' ELSE 'late' END AS state
  FROM rawid, h
)
"""


def _deliveries(spark, sf_dir) -> ledger_stream.LedgerSink:
    """Four deliveries, each taken in by a run of its own; silver is compacted on the way."""
    raw = mapping.raw_with_ids(spark, sf_dir)
    eid, step = F.col("event_id"), F.col(STEP)
    own = F.when(step <= DELIVERY_ENDS[0], 0).when(step <= DELIVERY_ENDS[1], 1).otherwise(2)
    root, ckpt = scratch_path(spark, "deliveries"), scratch_path(spark, "deliveries_ckpt")
    sink = ledger_stream.LedgerSink(spark, scratch_path(spark, "ledger"), LATENESS, compact_every=3)
    for k in range(4):
        tx = split.split_feeds(raw.where(own == k))[0]
        acct = split.split_feeds(raw.where((own == k) & (eid % mapping.WITHHOLD_ACCOUNTS_EVERY != 0)))[1]
        late = eid % mapping.WITHHOLD_FRAUD_EVERY == 0
        fraud = split.split_feeds(raw.where(own + late.cast("int") == k))[2]
        for name, df in zip(FEEDS, (tx, acct, fraud), strict=True):
            df.write.mode("append").parquet(f"{root}/{name}")
        ledger_stream.run_ledger_stream(spark, root, sink, ckpt)
    return sink


@register("silver_stream_late", _ACCOUNTS + """
SELECT transaction_id, step, 'transactions' AS feed, state FROM told
UNION ALL SELECT transaction_id, step, 'accounts', state FROM told WHERE NOT lost
UNION ALL SELECT transaction_id, step, 'fraud', state FROM told""")
def q_silver_stream_late(spark, sf_dir):
    """Every delivered row of several batches: matched, still pending, or late."""
    return _deliveries(spark, sf_dir).accounted()


@register("silver_stream_ledger", _ACCOUNTS + f"""
, {O.SILVER_CTE}
SELECT silver.* FROM silver JOIN told USING (transaction_id) WHERE state = 'matched'""")
def q_silver_stream_ledger(spark, sf_dir):
    """What the batches matched, read through the manifest after a compaction."""
    return _deliveries(spark, sf_dir).read(ledger_stream.SILVER)


# ------------------------------------------------------------ warehouse round trip

@register("warehouse_roundtrip", ORACLES["gold_refresh"])
def q_warehouse_roundtrip(spark, sf_dir):
    """The gold job into the warehouse source, published as one release, read back by table."""
    silver_path, root = scratch_path(spark, "silver"), scratch_path(spark, "warehouse")
    build_silver(*mapping.feeds(spark, sf_dir)).write.parquet(silver_path)
    release = warehouse.new_release()
    gold_job.run_gold(spark, silver_path, warehouse.to_release(spark, root, release))
    warehouse.publish(spark, root, release, GOLD_TABLES)
    out = None
    for table, (measure, _) in _GOLD_MEASURES.items():
        part = warehouse.read_warehouse(spark, root, table).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.sum(F.expr(measure)).cast("bigint").alias("covered"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------- verification, retention, drift, JSON read once

#: A CSV line of the profiled sample, as Spark writes it.
_PROFILED_CTES = """
WITH lines AS (
  SELECT id, concat_ws(',', id, name, age, city, purchase_amount, purchase_date, category, score,
    strftime(processed_timestamp, '%Y-%m-%dT%H:%M:%S.%g'), processing_job, row_id,
    name_upper, city_upper, category_upper) AS line
  FROM (""" + ORACLES["profile_csv"] + """) p
), head AS (
  SELECT 'id,name,age,city,purchase_amount,purchase_date,category,score,processed_timestamp,'
    || 'processing_job,row_id,name_upper,city_upper,category_upper' AS header
), first AS (
  SELECT line, row_number() OVER (ORDER BY id) - 1 AS n FROM lines ORDER BY id LIMIT 4
)
"""


@register("verify_output", _PROFILED_CTES + """
SELECT CAST(1 AS BIGINT) AS files, (SELECT count(*) FROM lines) AS rows,
  (SELECT CAST(sum(strlen(line) + 1) AS BIGINT) FROM lines) AS data_bytes,
  (SELECT CAST(sum(CAST(('0x' || substr(md5(line), 1, 15)) AS BIGINT)::HUGEINT) AS VARCHAR) FROM lines) AS digest,
  header, header || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY n) FROM first) AS preview, true AS ok
FROM head""")
def q_verify_output(spark, sf_dir):
    """The report on a profile job's single output file, its preview as one text."""
    report = verify.verify_output(spark, _profiled_output(spark, sf_dir))
    return report.withColumn("preview", F.array_join("preview", "\n"))


ORACLES["output_inventory"] = _PROFILED_CTES + """
SELECT CAST(1 AS BIGINT) AS files, CAST(any_value(strlen(header)) + 1 + sum(strlen(line) + 1) AS BIGINT)
  AS total_bytes, true AS ok FROM lines, head"""
ORACLES["output_preview"] = _PROFILED_CTES + """
SELECT CAST(0 AS INTEGER) AS line_no, header AS line FROM head
UNION ALL SELECT CAST(n + 1 AS INTEGER), line FROM first"""


@register("expired_files", O.BASE + f"""
SELECT f.feed AS "table", step,
  timestamp '2025-01-01 00:00:00' + to_hours(step + 1) <= timestamp '{RETENTION_AS_OF}' - INTERVAL 7 DAY AS expired
FROM (SELECT DISTINCT step FROM tx), (VALUES ('transactions'), ('accounts'), ('fraud')) f(feed)""")
def q_expired_files(spark, sf_dir):
    """Every step folder of the bronze feeds, and whether it expires as a whole."""
    return verify.step_folders(spark, _bronze(spark, sf_dir), RETENTION_AS_OF).select(
        "table", STEP, "expired")


@register("schema_drift", O.with_ctes(O.RAW_CTE) + """, n AS (
  SELECT count(*) AS rows, count(*) FILTER (event_id % 3 = 0) AS whole,
         count(*) FILTER (event_id % 3 = 1) AS wide FROM raw)
SELECT 'event_id' AS "column", 'int' AS type, 'int' AS seen, CAST(3 AS BIGINT) AS files, rows AS filled, rows FROM n
UNION ALL SELECT 'amount', 'double', 'double,int', 3, rows, rows FROM n
UNION ALL SELECT 'ts', 'timestamp', 'date,timestamp', 3, rows, rows FROM n
UNION ALL SELECT 'type', 'string', 'string', 3, rows, rows FROM n
UNION ALL SELECT 'isFraud', 'string', 'boolean,int', 3, rows, rows FROM n
UNION ALL SELECT 'channel', 'bigint', 'bigint', 1, wide, wide FROM n
UNION ALL SELECT 'note', 'void', 'void', 1, 0, whole FROM n""")
def q_schema_drift(spark, sf_dir):
    """Three deliveries of the same table whose columns and value types differ."""
    raw, eid = mapping.raw_events(spark, sf_dir), F.col("event_id")
    hour = F.timestamp_add("HOUR", F.col(STEP), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    stamp, day = F.date_format(hour, "yyyy-MM-dd HH:mm:ss"), F.date_format(hour, "yyyy-MM-dd")
    whole = F.floor("amount").cast("string")
    label = F.when(F.col("isFraud") == 1, "true").otherwise("false")
    root = scratch_path(spark, "drifting")
    shapes = {
        0: [eid, whole.alias("amount"), day.alias("ts"), F.col("type"), F.col("isFraud"),
            F.lit(None).cast("string").alias("note")],
        1: [F.col("type"), eid, F.concat(whole, F.lit(".5")).alias("amount"), stamp.alias("ts"),
            F.col("isFraud"), (eid + 5_000_000_000).alias("channel")],
        2: [eid, F.col("type"), F.concat(whole, F.lit(".25")).alias("amount"), stamp.alias("ts"),
            label.alias("isFraud")]}
    for k, columns in shapes.items():
        part = raw.where(eid % 3 == k).select(*columns)
        writers.write_any(part, f"{root}/delivery{k}", "csv", files=1)
    lines = delivered.read_lines(spark, root, recursive=True)
    return drift.schema_drift(drift.file_columns(lines))


@register("profile_json_variant", ORACLES["profile_json"])
def q_profile_json_variant(spark, sf_dir):
    """The JSON profile without an inference pass: the input is read once."""
    path = scratch_path(spark, "tx_json")
    writers.write_any(mapping.feeds(spark, sf_dir)[0], path, "json")
    got = read_json_lines(spark, path)
    return got.rows.select("*", *audit_columns(FIXED_PROCESSED_AT),
                           F.lit(got.n_rows).cast("bigint").alias("record_count"))

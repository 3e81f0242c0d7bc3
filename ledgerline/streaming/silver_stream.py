"""Incremental silver: stream the three feed directories, join, enrich, append.

Each run (``trigger(availableNow=True)``) picks up the files that arrived
since the last run, recorded in the checkpoint; a run with no new files adds
nothing. Rows whose partner feeds arrive in a later run are joined then,
because the join keeps state.

Without a watermark that state is unbounded. With ``watermark`` the join also
matches on the event time ``base + step hours`` of all three feeds (the step
comes from the partition directory), so Spark drops state older than the
watermark; feed rows later than that are dropped by the join and show up in
the batch report of :func:`ledgerline.operators.quality.unmatched_keys`.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.columns import EVENT_TIME_BASE, event_time
from ledgerline.operators.silver import add_is_corrupt, add_transaction_time
from ledgerline.schemas import FEED_SCHEMAS, KEY, SILVER_COLUMNS, STEP, with_step

_ET = "_event_hour"

# Join state per key lives in a state store. The default store keeps all of it
# in executor memory; RocksDB keeps it on local disk with bounded memory (and
# checkpoints it to the checkpoint location), so a key whose copies are a large
# share of all rows does not exhaust an executor.
STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "memory": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}
_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
# RocksDB cannot tell its number of rows: Spark counts them with one more read before every write
_COUNT_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# tasks of a listing job; Spark's own default is one task per step folder, nine times in a run
_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set SQL confs for the duration of a query start, then restore them."""
    previous = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _listing_conf(spark: SparkSession) -> dict[str, str]:
    """One listing task per core, unless the session names a number."""
    if spark.conf.get(_LISTING_KEY, None) is not None:
        return {}
    return {_LISTING_KEY: str(spark.sparkContext.defaultParallelism)}


def feed_stream(spark: SparkSession, root: str, feed: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    schema = with_step(FEED_SCHEMAS[feed])
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(f"{root.rstrip('/')}/{feed}")


def silver_stream_frame(transactions: DataFrame, accounts: DataFrame, fraud: DataFrame,
                        watermark: str | None = None,
                        base: str = EVENT_TIME_BASE) -> DataFrame:
    """Streaming silver rows from three streaming feeds."""
    if watermark:
        def timed(df: DataFrame) -> DataFrame:
            # watermarks need a zoned TIMESTAMP; the column is internal only
            et = event_time(STEP, None, base).cast("timestamp")
            return df.withColumn(_ET, et).withWatermark(_ET, watermark)
        transactions, accounts, fraud = timed(transactions), timed(accounts), timed(fraud)
        on = [KEY, _ET]
    else:
        on = [KEY]
    joined = (transactions.join(accounts.drop(STEP), on, "inner")
              .join(fraud.drop(STEP), on, "inner"))
    enriched = add_is_corrupt(add_transaction_time(joined))
    return enriched.select(*SILVER_COLUMNS)


def start_silver_stream(spark: SparkSession, bronze_root: str, sink_path: str,
                        checkpoint: str, fmt: str = "parquet",
                        watermark: str | None = None,
                        max_files_per_trigger: int | None = None,
                        available_now: bool = True,
                        processing_time: str | None = None,
                        state_partitions: int | None = None,
                        state_store: str | None = "rocksdb",
                        count_state: bool = True) -> StreamingQuery:
    """Start the stream into a parquet table at ``sink_path``.

    The three feed folders must exist (they may be empty).

    ``available_now`` processes what is there and stops (incremental batch);
    otherwise ``processing_time`` sets a micro-batch interval.
    ``state_partitions`` fixes the number of join-state partitions for a new
    checkpoint (default: the session's ``spark.sql.shuffle.partitions``);
    ``state_store`` (``"rocksdb"``, ``"memory"`` or ``None`` for the session's
    setting) picks the state store of a new checkpoint. Spark keeps both as
    stored in an existing checkpoint. ``count_state=False`` spares RocksDB the
    read before every write that only serves the progress's ``numRowsTotal``
    (0 then); state and rows are the same, and a checkpoint may change between
    both. A backfill of many steps in one run
    should bound its micro-batches with ``max_files_per_trigger``.
    """
    if watermark and max_files_per_trigger:
        raise ValueError(
            "watermark with max_files_per_trigger loses rows: a bounded micro-batch may move the "
            "watermark past steps whose files are still to come; use the batch job for a backfill")
    conf = _listing_conf(spark)
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store is not None:
        if state_store not in STATE_STORES:
            raise ValueError(f"state_store must be one of {sorted(STATE_STORES)}")
        conf[_STORE_KEY] = STATE_STORES[state_store]
    if not count_state:
        conf[_COUNT_KEY] = "false"
    with _session_conf(spark, conf):
        feeds = [feed_stream(spark, bronze_root, f, fmt, max_files_per_trigger)
                 for f in FEED_SCHEMAS]
        out = silver_stream_frame(*feeds, watermark=watermark)
        w = (out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).option("path", sink_path)
             .partitionBy(STEP))
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        return w.start()


def _state_rows(progress: list[dict]) -> int | None:
    """Rows added to the join state less rows removed; ``None`` unless the batches are all there from the first on."""
    if [p["batchId"] for p in progress] != list(range(len(progress))):
        return None
    return sum(op["numRowsUpdated"] - op["numRowsRemoved"]
               for p in progress for op in p.get("stateOperators", []))


def run_silver_stream_once(spark: SparkSession, bronze_root: str, sink_path: str,
                           checkpoint: str, fmt: str = "parquet",
                           watermark: str | None = None,
                           timeout_s: float | None = None,
                           state_partitions: int | None = None,
                           state_store: str | None = "rocksdb",
                           max_files_per_trigger: int | None = None,
                           count_state: bool = True) -> dict:
    """One incremental run; returns the number of micro-batches, input rows,
    rows dropped as later than the watermark, the rows held in join state after
    the last batch and the state store. All batches of the run are counted.
    With ``count_state=False`` the rows in state are those the batches added
    less those they removed, which is known for the first run of a checkpoint
    (``None`` for a later one)."""
    # the query keeps only its last progress entries: gather them while it runs
    seen: dict[int, dict] = {}
    deadline = None if timeout_s is None else time.monotonic() + timeout_s

    def gather() -> None:
        for p in q.recentProgress:
            p = p if isinstance(p, dict) else p.jsonValue()
            seen[p["batchId"]] = p
    with _session_conf(spark, _listing_conf(spark)):  # sources list with the caller's session, not the query's
        q = start_silver_stream(spark, bronze_root, sink_path, checkpoint, fmt, watermark,
                                max_files_per_trigger=max_files_per_trigger,
                                state_partitions=state_partitions, state_store=state_store,
                                count_state=count_state)
        while not q.awaitTermination(2):
            gather()
            if deadline is not None and time.monotonic() > deadline:
                q.stop()
                raise TimeoutError("silver stream did not finish in time")
    gather()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    progress = [seen[k] for k in sorted(seen)]
    rows = sum(p["numInputRows"] for p in progress)
    ops = progress[-1].get("stateOperators", []) if progress else []
    metrics = set().union(*[op.get("customMetrics", {}) for op in ops]) if ops else set()
    return {"batches": len(progress), "input_rows": rows,
            "dropped_by_watermark": sum(op.get("numRowsDroppedByWatermark", 0)
                                        for p in progress for op in p.get("stateOperators", [])),
            "state_rows": sum(op.get("numRowsTotal", 0) for op in ops) if count_state
            else _state_rows(progress),
            "state_store": "rocksdb" if any(m.startswith("rocksdb") for m in metrics)
            else ("memory" if ops else None)}

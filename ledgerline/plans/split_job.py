"""Split job: wide raw table -> three source feeds, one directory per step.

``raw -> stats -> with_transaction_id -> write 3 feeds -> reconcile``.

Passes over ``raw``: one aggregate (row count and number of steps, which
bounds the id summary and is the ``rows_in`` of the reconciliation), the
range partitioner's sample, and the range shuffle that numbers the rows.
The numbering stores its sorted rows once below the shared checkpoint folder, so
the three writes neither repeat the sort nor go back to the raw input when an
executor is lost. Because those rows are range-partitioned and sorted by step,
the feed writes read their own columns of them and run without any shuffle.
The report takes the rows from the writes and the batches from the folders;
nothing is read back, and the stored copy is dropped in the end.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.folders import Folders
from ledgerline.operators.quality import reconcile_counts
from ledgerline.operators.split import (
    ID_PREFIX, batch_stats, ids_keep_step_layout, split_feeds, with_transaction_id)
from ledgerline.schemas import FEEDS, KEY, RAW_SCHEMA, STEP
from ledgerline.session import build_session, drop_scratch, scratch_path
from ledgerline.sinks.writers import clustered, write_feeds
from ledgerline.sources import delivered
from ledgerline.sources.feeds import read_raw


def write_split_feeds(spark: SparkSession, ided: DataFrame, out_root: str,
                      fmt: str = "csv", partitions: int | None = None,
                      step_clustered: bool = False) -> dict[str, int]:
    """Write the three feeds of a wide table that already has ids.

    The table is laid out once (range partitions on ``(step, id)``, skipped
    when ``step_clustered`` says it already is) and written as a staging
    parquet table below the shared checkpoint folder. That cuts the lineage
    (a lost executor does not send the writes back to the raw input), and
    each feed write reads only its own columns of the staging copy, with no
    shuffle: its files hold contiguous, sorted step ranges, so each step
    still lands in about one file per feed. Three separately clustered
    writes would compute, sample and shuffle the input three times.
    The staging copy is removed once the feeds are written. Returns the rows per feed.
    """
    if not step_clustered:
        ided = clustered(ided, [STEP], [KEY], partitions)
    stage = scratch_path(spark, "split-stage")
    ided.write.mode("overwrite").parquet(stage)
    wide = spark.read.parquet(stage)
    rows = write_feeds(dict(zip(FEEDS, split_feeds(wide))), out_root, fmt, partitions,
                       cluster=False)
    drop_scratch(spark, stage)
    return rows


def run_split(spark: SparkSession, raw: DataFrame, out_root: str, fmt: str = "csv",
              partitions: int | None = None, has_ids: bool = False) -> DataFrame:
    """Write the feeds of ``raw`` below ``out_root``; return the reconciliation
    report (rows in vs rows written, per feed)."""
    rows_in, n_steps = batch_stats(raw)
    if has_ids:
        rows = write_split_feeds(spark, raw, out_root, fmt, partitions)
    else:
        n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        stored = scratch_path(spark, "ranked")
        ided = with_transaction_id(raw, partitions=n_parts, n_steps=n_steps, stored=stored)
        if ids_keep_step_layout(n_parts, n_steps):
            rows = write_feeds(dict(zip(FEEDS, split_feeds(ided))), out_root, fmt, partitions,
                               cluster=False)
        else:
            rows = write_split_feeds(spark, ided, out_root, fmt, partitions)
        drop_scratch(spark, stored)
    folders = Folders(spark)
    batches = {f: sum(n.startswith(f"{STEP}=") and n[len(STEP) + 1:].lstrip("-").isdigit()
                      for n in folders.names(f"{out_root.rstrip('/')}/{f}")) for f in FEEDS}
    return reconcile_counts(spark, rows_in, rows, batches)


def with_input_index(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
                     id_col: str = KEY) -> DataFrame:
    """The rows of headed CSV files with ``transaction_id = TXN-{step}-{n}``, ``n`` the row's place in the input.

    ``n`` counts the rows of all files, in order of file name and line, from 0
    (``line_index``): the numbering of a single pass over the input. Rows are
    typed by header name; what does not fit stays listed in ``_failed`` and
    ``_whole_line``. The typed rows are stored once below the shared checkpoint
    folder, the copy must outlive the result.
    """
    rows = delivered.rescue(delivered.read_lines(spark, path, recursive=True), schema)
    stored = scratch_path(spark, "input-index")
    rows.write.parquet(stored)
    numbered = delivered.with_line_index(spark.read.schema(rows.schema).parquet(stored))
    txn = F.concat_ws("-", F.lit(ID_PREFIX), F.col(STEP).cast("string"),
                      F.col("line_index").cast("string"))
    return numbered.withColumn(id_col, txn)


def main(argv: list[str] | None = None) -> None:
    """``split_job RAW OUT``: split a raw table into its feeds; fails on a row loss."""
    args = argparse.ArgumentParser(prog="split_job")
    args.add_argument("raw")
    args.add_argument("out")
    args.add_argument("--fmt", default="csv")
    a = args.parse_args(argv)
    spark = build_session(app_name="split")
    report = run_split(spark, read_raw(spark, a.raw), a.out, a.fmt).collect()
    for row in report:
        print(row.asDict())
    if not all(row["ok"] for row in report):
        raise SystemExit("rows written differ from rows read")


if __name__ == "__main__":
    main()

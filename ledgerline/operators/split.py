"""Source-system split of the wide transaction table (bronze input side).

* :func:`with_transaction_id` numbers rows per ``step`` (``TXN-{step}-{n}``).
* :func:`split_feeds` cuts the wide table into the three source feeds.
* :func:`step_counts` gives the batch sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators._joins import MAX_BROADCAST_ROWS, join_bounded
from ledgerline.schemas import KEY, STEP
from ledgerline.session import scratch_path

ID_PREFIX = "TXN"  # fixed value: ids read TXN-{step}-{n}
TIEBREAK = "_tiebreak"


def _default_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batch_stats(raw: DataFrame) -> tuple[int, int]:
    """``(rows, steps)`` of a table in one aggregate pass; a NULL step counts
    as one more step. Two numbers reach the driver, no rows."""
    null_step = F.coalesce(F.max(F.col(STEP).isNull().cast("int")), F.lit(0))
    r = raw.agg(F.count(F.lit(1)).alias("rows"),
                (F.count_distinct(STEP) + null_step).alias("steps")).first()
    return int(r["rows"]), int(r["steps"])


def ids_keep_step_layout(partitions: int, n_steps: int) -> bool:
    """Whether :func:`with_transaction_id` returns rows still range-partitioned
    and sorted by ``(step, ...)``: true when its run summary (at most
    ``partitions + n_steps`` rows) is broadcast, so the big side is never
    reshuffled."""
    return partitions + n_steps <= MAX_BROADCAST_ROWS


def with_transaction_id(raw: DataFrame, order_by: list[str] | None = None, *,
                        partitions: int | None = None, n_steps: int | None = None,
                        id_col: str = KEY, stored: str | None = None) -> DataFrame:
    """Add ``transaction_id = TXN-{step}-{n}``, ``n`` = 0-based rank in the step.

    The rank follows ``order_by`` (default: every column, so equal ranks can
    only go to identical rows and the result is repeatable). The numbering is
    exact and equals ``row_number() OVER (PARTITION BY step ORDER BY ...) - 1``,
    but it does not run as such a window: one hot step would then be one task.
    Instead:

    1. a global range sort on ``(step, order_by, input position)`` splits even
       a single huge step, or a huge group of identical rows, over many
       partitions;
    2. ``monotonically_increasing_id`` gives each row its position inside its
       partition;
    3. a per ``(partition, step)`` summary (at most ``partitions + n_steps``
       rows) yields each run's offset through a running sum;
    4. the summary is joined back; it is broadcast only when that bound is
       known to be small (``n_steps`` is counted if not given).

    The sorted rows are stored once below the shared checkpoint folder (or at
    ``stored``; the caller drops it when the result is no longer read), and
    both the summary and the numbering read that copy: they always see the same
    partitions, whatever the planner does. With the broadcast, the result keeps the stored ranges:
    rows clustered by ``step`` (:func:`ids_keep_step_layout`),
    so step-partitioned writes of it need no further shuffle.
    """
    keys = list(order_by) if order_by else [c for c in raw.columns if c != STEP]
    n_parts = partitions or _default_partitions(raw)
    # the input position breaks ties last: rows equal on every key are
    # interchangeable, so which copy gets which number does not change the
    # result, but range bounds can then cut a large group of copies
    sort_cols = ([F.col(STEP).asc_nulls_first()] + [F.col(k).asc_nulls_first() for k in keys]
                 + [F.col(TIEBREAK)])

    ranked = (raw.withColumn(TIEBREAK, F.monotonically_increasing_id())
              .repartitionByRange(n_parts, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id())
              .drop(TIEBREAK))
    stored = stored or scratch_path(raw.sparkSession, "ranked")
    ranked.write.parquet(stored)
    ranked = raw.sparkSession.read.schema(ranked.schema).parquet(stored)

    runs = ranked.groupBy("_pid", STEP).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(STEP).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_pid").alias("_rpid"), F.col(STEP).alias("_rstep"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))

    if n_steps is None:
        n_steps = batch_stats(raw)[1]
    cond = (F.col("_pid") == F.col("_rpid")) & F.col(STEP).eqNullSafe(F.col("_rstep"))
    joined = join_bounded(ranked, runs, cond, "inner", n_parts + n_steps)

    rank = F.col("_offset") + F.col("_pos") - F.col("_first")
    txn_id = F.concat_ws("-", F.lit(ID_PREFIX), F.col(STEP).cast("string"),
                         rank.cast("string"))
    return joined.select(*[F.col(c) for c in raw.columns], txn_id.alias(id_col))


def split_feeds(raw: DataFrame, keep_step: bool = True
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut the wide table (with ``transaction_id``) into the three feeds.

    Returns ``(transactions, accounts, fraud)``. With ``keep_step`` the
    accounts and fraud feeds also carry ``step`` (their batch / partition key);
    without it they have exactly the source systems' columns.
    """
    extra = [STEP] if keep_step else []
    transactions = raw.select(
        KEY, STEP, "type", "amount",
        F.col("nameOrig").alias("origin_account_id"),
        F.col("nameDest").alias("dest_account_id"))
    accounts = raw.select(KEY, "oldbalanceOrg", "newbalanceOrig",
                          "oldbalanceDest", "newbalanceDest", *extra)
    fraud = raw.select(KEY, "isFraud", "isFlaggedFraud", *extra)
    return transactions, accounts, fraud


def step_counts(df: DataFrame) -> DataFrame:
    """Rows per batch: ``(step, rows)``; NULL steps form their own row."""
    return df.groupBy(STEP).agg(F.count(F.lit(1)).alias("rows"))

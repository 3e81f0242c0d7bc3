"""Sinks. Every write is one distributed job; none squeezes data into one task.

* :func:`write_batch` - silver table, partitioned by ``step``; ``replace``
  rewrites only the steps present in the data (dynamic partition overwrite),
  so rerunning a step is idempotent; ``append`` adds rows.
* :func:`write_any` - generic CSV / JSON / parquet output.
* :func:`write_warehouse` - one table of a warehouse (JDBC by default).
* :func:`write_feeds` - the three source feeds, one directory each.
* :func:`land_batch` - bronze landing of complete steps only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.quality import feed_completeness
from ledgerline.schemas import FEEDS, KEY, STEP

WRITE_MODES = ("replace", "append", "overwrite")


LAYOUTS = ("range", "rebalance")
_TIEBREAK = "_tiebreak"


def clustered(df: DataFrame, by: list[str], secondary: list[str],
               partitions: int | None, layout: str = "range") -> DataFrame:
    """Lay rows out so each write task covers few partition directories.

    ``range`` (default): range-partition on ``by + secondary`` into
    ``partitions`` tasks (default ``spark.sql.shuffle.partitions``); the
    secondary key (and the input position after it) lets the range bounds cut
    through a hot step or a hot key, so neither has to fit one task. ``rebalance``: the ``REBALANCE`` hint; AQE
    sizes the tasks by bytes and splits skewed steps itself (fewer files, but
    fewer tasks for small data). A plain ``repartition(step)`` would put a
    hot step into a single task.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "rebalance":
        return df.hint("rebalance", *by) if partitions is None else \
            df.hint("rebalance", partitions, *by)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # input position as the last key: a key with very many copies can still be
    # cut by the range bounds (it only decides which file a copy lands in)
    return (df.withColumn(_TIEBREAK, F.monotonically_increasing_id())
            .repartitionByRange(n, *(by + secondary), _TIEBREAK).drop(_TIEBREAK))


def write_batch(df: DataFrame, path: str, mode: str = "replace", fmt: str = "parquet",
                partition_by: Iterable[str] = (STEP,), cluster_by: Iterable[str] = (KEY,),
                cluster: bool = True, partitions: int | None = None,
                max_records_per_file: int | None = None,
                observe: tuple | None = None, layout: str = "range") -> None:
    """Write a batch of a step-partitioned table.

    ``replace``: overwrite only the partitions present in ``df`` (a step that
    became empty is not cleared). ``append``: add rows; running the same
    step twice then duplicates it. ``overwrite``: replace the whole table
    (every step not in ``df`` disappears), written in place without the
    per-partition staging and renames of ``replace``. ``observe=(Observation, *metrics)`` is
    attached right before the write, above the clustering shuffle, so the
    range partitioner's sampling pass does not count rows a second time.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    parts = list(partition_by)
    if cluster and parts:
        df = clustered(df, parts, [c for c in cluster_by if c in df.columns], partitions,
                        layout)
    if observe:
        df = df.observe(*observe)
    w = df.write.format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if parts:
        w = w.partitionBy(*parts)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if mode == "replace":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        w = w.mode("append")
    w.save(path)


def write_any(df: DataFrame, path: str, fmt: str = "csv", files: int | None = None,
              mode: str = "overwrite", header: bool = True) -> None:
    """Generic output. ``files`` coalesces to that many files only on request
    (``coalesce(1)`` puts the whole final stage into one task)."""
    if files:
        df = df.coalesce(files)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def write_warehouse(df: DataFrame, table: str, options: Mapping[str, str],
                    fmt: str = "jdbc", mode: str = "overwrite") -> None:
    """Replace one warehouse table: base ``options`` + ``dbtable=table``.

    Connection settings (url, user, driver, credentials) come only from the
    caller. Partitions write in parallel; bound the number of concurrent
    connections with ``numPartitions`` in ``options``.
    """
    (df.write.format(fmt).options(**dict(options)).option("dbtable", table)
     .mode(mode).save())


def write_feeds(feeds: Mapping[str, DataFrame], root: str, fmt: str = "csv",
                partitions: int | None = None, cluster: bool = True) -> dict[str, int]:
    """Each feed to ``<root>/<feed>/step=<n>/``; each feed folder is reset
    first, like the source split does (whole-table overwrite).

    ``cluster=False`` writes the feeds in their current layout, for inputs
    that are already range-partitioned and sorted by ``step`` (as the output
    of :func:`ledgerline.operators.split.with_transaction_id` is): no shuffle
    per feed, and still about one file per step and task. Returns the rows with
    a step that each feed's write counted while writing.
    """
    rows = {}
    for name, df in feeds.items():
        seen = Observation(f"feed-{name}")
        write_batch(df, f"{root.rstrip('/')}/{name}", mode="overwrite", fmt=fmt,
                    partitions=partitions, cluster=cluster,
                    observe=(seen, F.count(F.col(STEP)).alias("rows")))
        rows[name] = seen.get["rows"]
    return rows


class IncompleteBatchError(RuntimeError):
    """A step lacks at least one of the three feeds; ``report`` has all steps."""

    def __init__(self, message: str, report: DataFrame | None = None):
        super().__init__(message)
        self.report = report


def land_batch(spark: SparkSession, feeds: Mapping[str, DataFrame], dst_root: str,
               steps: Iterable[int] | None = None, fmt: str = "parquet",
               partitions: int | None = None) -> DataFrame:
    """Bronze landing: write the feeds of complete steps, refuse otherwise.

    The completeness check runs first (one small aggregation over the step
    columns); if a requested step misses a feed, nothing is written and
    :class:`IncompleteBatchError` names up to 20 such steps. Each landed row
    keeps ``_source_file`` when the input carries it. Returns the
    completeness report.
    """
    if set(feeds) != set(FEEDS):
        raise IncompleteBatchError(f"feeds given: {sorted(feeds)}; needed: {sorted(FEEDS)}")
    if steps is not None:
        wanted = [int(s) for s in steps]
        feeds = {n: d.filter(F.col(STEP).isin(wanted)) for n, d in feeds.items()}
        expected = spark.createDataFrame([(s,) for s in wanted], f"{STEP} int")
    else:
        expected = None
    report = feed_completeness(feeds, expected)
    bad = [r[0] for r in report.filter(~F.col("complete")).select(STEP)
           .orderBy(STEP).limit(20).collect()]
    if bad:
        raise IncompleteBatchError(f"steps missing a feed (first 20): {bad}", report)
    # one step needs no clustering: each input split writes one file of it
    cluster = steps is None or len(wanted) > 1
    for name in FEEDS:
        write_batch(feeds[name], f"{dst_root.rstrip('/')}/{name}", mode="replace",
                    fmt=fmt, partitions=partitions, cluster=cluster)
    return report

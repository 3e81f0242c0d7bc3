"""Readers of the three source feeds and of the wide raw table.

Feeds are stored one directory per feed, partitioned by ``step``
(``<root>/<feed>/step=<n>/``); with given steps only those directories are
listed and read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.folders import Folders
from ledgerline.schemas import FEED_SCHEMAS, FEEDS, RAW_SCHEMA, STEP, with_step


def select_batch(df: DataFrame, steps: Iterable[int] | int | None) -> DataFrame:
    """Keep the given steps (all if ``None``); on a partition column this
    prunes whole directories."""
    if steps is None:
        return df
    if isinstance(steps, int):
        steps = [steps]
    return df.filter(F.col(STEP).isin(list(steps)))


#: From this many steps on, the base folder is listed once instead of asking for each step.
LIST_FROM = 8


def step_paths(spark: SparkSession, base: str, steps: Iterable[int]) -> list[str]:
    """The folders of the given steps that exist below ``base``.

    A few steps are asked for one by one, whatever the history holds; for more
    the base folder is listed once.
    """
    folders, names = Folders(spark), [f"{STEP}={int(s)}" for s in dict.fromkeys(steps)]
    if len(names) < LIST_FROM:
        return [f"{base}/{n}" for n in names if folders.exists(f"{base}/{n}")]
    there = set(folders.names(base))
    return [f"{base}/{n}" for n in names if n in there]


def read_feed(spark: SparkSession, root: str, feed: str,
              steps: Iterable[int] | int | None = None, fmt: str = "csv",
              with_source_file: bool = False) -> DataFrame:
    """One feed with its explicit schema plus ``step`` from the directory.

    With ``steps`` only their folders are listed, whatever the history holds;
    a step without a folder has no rows.
    """
    schema = with_step(FEED_SCHEMAS[feed])
    base = f"{root.rstrip('/')}/{feed}"
    if isinstance(steps, int):
        steps = [steps]
    paths = [base] if steps is None else step_paths(spark, base, steps := list(steps))
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        # a header that does not name the columns in this order is refused
        reader = reader.option("header", True).option("enforceSchema", False)
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("_source_file", F.lit("")) if with_source_file else empty
    df = reader.option("basePath", base).load(paths)
    df = select_batch(df, steps).select(*schema.fieldNames())
    if with_source_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def read_feeds(spark: SparkSession, root: str, steps=None, fmt: str = "csv"
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(transactions, accounts, fraud)`` for the given steps."""
    return tuple(read_feed(spark, root, f, steps, fmt) for f in FEEDS)  # type: ignore


def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The wide raw table with its explicit schema (header line expected)."""
    reader = spark.read.schema(RAW_SCHEMA).format(fmt)
    if fmt == "csv":
        # a header that does not name the columns in this order is refused
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path)

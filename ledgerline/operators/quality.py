"""Data-quality and verification operators.

All return DataFrames (reports are data, not log lines) and run as Spark
jobs: counts are global aggregates, key checks are one shuffle over the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import FEEDS, KEY, STEP


def reconcile(raw: DataFrame | int, feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in vs rows out per feed after a split.

    Returns ``feed, rows_in, rows_out, missing, batches, ok``. ``rows_out``
    counts rows that land in a batch (non-NULL ``step``), ``batches`` the
    distinct steps (both per feed, in one job over the union of the feeds).
    ``raw`` is the input table, counted first (one number to the driver), or
    its row count when the caller already has it from an earlier pass.
    """
    rows_in = int(raw) if not isinstance(raw, DataFrame) else raw.count()
    outs = None
    for name, df in feeds.items():
        part = df.agg(F.lit(name).alias("feed"),
                      F.count(F.col(STEP)).alias("rows_out"),
                      F.countDistinct(F.col(STEP)).alias("batches"))
        outs = part if outs is None else outs.unionByName(part)
    rep = outs.withColumn("rows_in", F.lit(rows_in).cast("bigint"))
    missing = F.col("rows_in") - F.col("rows_out")
    return rep.select("feed", "rows_in", "rows_out", missing.alias("missing"),
                      "batches", (missing == 0).alias("ok"))


def reconcile_counts(spark: SparkSession, rows_in: int, rows_out: Mapping[str, int],
                     batches: Mapping[str, int]) -> DataFrame:
    """The report of :func:`reconcile` from counts taken while the feeds were written."""
    report = [(f, rows_in, n, rows_in - n, batches[f], rows_in == n) for f, n in rows_out.items()]
    return spark.createDataFrame(report, "feed string, rows_in bigint, rows_out bigint, "
                                         "missing bigint, batches bigint, ok boolean")


def feed_completeness(feeds: Mapping[str, DataFrame],
                      expected_steps: DataFrame | None = None) -> DataFrame:
    """Which feeds delivered each step: ``step, has_<feed>..., complete``.

    One aggregation over the union of the feeds' ``step`` columns (partial
    aggregation leaves at most one row per step and map task before the
    shuffle). ``expected_steps`` (a ``step`` column) adds steps no feed has.
    """
    tagged = None
    for i, (name, df) in enumerate(feeds.items()):
        part = df.select(F.col(STEP), F.lit(1 << i).alias("_bit"))
        tagged = part if tagged is None else tagged.unionByName(part)
    present = tagged.groupBy(STEP).agg(F.bit_or("_bit").alias("_mask"))
    if expected_steps is not None:
        present = (expected_steps.select(STEP).distinct()
                   .join(present, STEP, "full_outer"))
    mask = F.coalesce(F.col("_mask"), F.lit(0))
    flags = [((mask.bitwiseAND(F.lit(1 << i))) != 0).alias(f"has_{name}")
             for i, name in enumerate(feeds)]
    full = (1 << len(feeds)) - 1
    return present.select(STEP, *flags, (mask == full).alias("complete"))


def key_presence(feeds: Mapping[str, DataFrame], on: Sequence[str] = (KEY, STEP)
                 ) -> DataFrame:
    """Per key: how many rows each feed holds (``n_<feed>``).

    A single shuffle over the union of all keys, with map-side partial counts,
    replaces one anti-join per pair of feeds.
    """
    on = list(on)
    names = list(feeds)
    tagged = None
    for name, df in feeds.items():
        part = df.select(*on, F.lit(name).alias("_feed"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = [F.count(F.when(F.col("_feed") == n, 1)).alias(f"n_{n}") for n in names]
    return tagged.groupBy(*on).agg(*counts)


def unmatched_keys(feeds: Mapping[str, DataFrame], on: Sequence[str] = (KEY, STEP)
                   ) -> DataFrame:
    """Keys an inner join of the feeds would lose: ``<on>..., missing_feed``.

    One row per key and feed that lacks it; NULL keys never match, so they
    are reported too.
    """
    pres = key_presence(feeds, on)
    miss = F.array_compact(F.array(*[
        F.when(F.col(f"n_{n}") == 0, F.lit(n)) for n in feeds]))
    return (pres.select(*on, F.explode(miss).alias("missing_feed")))


def duplicate_keys(feeds: Mapping[str, DataFrame], on: Sequence[str] = (KEY, STEP)
                   ) -> DataFrame:
    """Keys delivered more than once by a feed: ``feed, <on>..., copies``."""
    pres = key_presence(feeds, on)
    dup = F.array_compact(F.array(*[
        F.when(F.col(f"n_{n}") > 1,
               F.struct(F.lit(n).alias("feed"), F.col(f"n_{n}").alias("copies")))
        for n in feeds]))
    return (pres.select(*on, F.explode(dup).alias("_d"))
            .select(F.col("_d.feed").alias("feed"), *on, F.col("_d.copies").alias("copies")))


def corrupt_rows(silver: DataFrame) -> DataFrame:
    """Rows whose balance check failed (the quality flag used as a filter)."""
    return silver.filter(F.col("is_corrupt"))


def corrupt_rate(silver: DataFrame, by: Sequence[str] = ("type",)) -> DataFrame:
    """Share of flagged rows: ``<by>..., rows, corrupt_rows, corrupt_rate``.

    ``rows`` counts rows with a known flag; the rate is their exact ratio.
    """
    flag = F.col("is_corrupt")
    out = silver.groupBy(*by).agg(
        F.count(flag).alias("rows"),
        F.count(F.when(flag, 1)).alias("corrupt_rows"))
    return out.withColumn("corrupt_rate", F.try_divide(
        F.col("corrupt_rows").cast("double"), F.col("rows").cast("double")))


def describe_schema(df: DataFrame) -> DataFrame:
    """The schema as data: ``position, name, type, nullable``."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 20, by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (top-k, no full sort)."""
    keys = list(by) if by else df.columns
    return df.orderBy(*keys).limit(n)


def expired(df: DataFrame, ts_col: str, as_of: str | datetime, days: int = 7
            ) -> DataFrame:
    """Rows (or files) older than ``as_of - days``: strict ``<``.

    Selection only; deleting is up to the caller. ``as_of`` is a
    ``TIMESTAMP_NTZ`` literal, so the cut-off does not depend on the zone.
    """
    cut = F.timestamp_add("DAY", F.lit(-days), F.lit(as_of).cast("timestamp_ntz"))
    return df.filter(F.col(ts_col).cast("timestamp_ntz") < cut)


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as a one-row DataFrame (``rows``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))

"""Shared helpers: tables, lineage cuts, Arrow text buffers, word hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: Bytes of text handled at once inside a task; bounds numpy's working arrays.
SLICE_BYTES = 2 << 20
#: Rows up to which a table of a few numbers a row may be broadcast (counted first).
BROADCAST_ROWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor makes later stages reread files instead
    of recomputing everything.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``rows`` rows.

    Beyond that the planner's shuffle join is used; the result is the same.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``rank`` (from 0) in their group and the group's ``total``.

    A range sort spreads even a group that holds all rows; the sorted copy is
    stored, and each partition's share of a group gets its offset from a
    summary of at most partitions + groups rows. Equal rows may take each
    other's rank.
    """
    cols = [F.col(group)] + [F.col(c).asc_nulls_first() for c in order]
    at = F.monotonically_increasing_id()
    laid = (nodes.withColumn("_in", at).repartitionByRange(*cols, F.col("_in"))
            .sortWithinPartitions(*cols, F.col("_in")).drop("_in")
            .withColumn("_part", F.spark_partition_id()).withColumn("_at", at))
    laid = cut(laid, "ordered")
    runs = laid.groupBy("_part", group).agg(F.min("_at").alias("_first"),
                                            F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut(runs.select("_part", group, "_first", F.sum("_n").over(whole).alias("total"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
               "ordered-runs")
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return (laid.join(small(runs), ["_part", group]).withColumn("rank", rank)
            .drop("_part", "_at", "_first", "_before"))


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, _UPPER, _LOWER)


def text_only(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text); a null text counts as empty."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offset into them."""
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    col = col.fill_null("") if col.null_count else col
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data else np.empty(0, np.uint8)
    return raw, off - off[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``max_bytes`` of ``column`` (a row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def _rng_table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)


_BYTE = _rng_table(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def token_bounds(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Starts and ends of the runs of word bytes, and each row's range of runs.

    Runs never cross rows. ``is_word`` is a table of 256 flags.
    """
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = w[:-1]
    first = off[:-1][off[:-1] < n]
    before[first] = False
    starts = np.flatnonzero(w & ~before)
    after = np.zeros(n, bool)
    after[:-1] = w[1:]
    last = off[1:][off[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    total = int(first[-1] + lens[-1])
    in_word = np.arange(total) - np.repeat(first, lens)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lens.max()) - 1, _BASE)]),
                       dtype=np.uint64)
    value = _BYTE[data[in_word + np.repeat(starts, lens)]] * power[in_word]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64))

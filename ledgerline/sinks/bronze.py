"""Bronze as delivered: the lines of the feed files, as text, with their place and load.

Nothing is interpreted on the way in, so nothing can be lost: a value that does
not fit its type, a new column or another column order lands as it stands. The
typed table is a view over the landed lines (:func:`typed_feed`), and what does
not fit shows up in :func:`malformed_values`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.folders import Folders
from ledgerline.schemas import FEED_SCHEMAS, FEEDS, STEP
from ledgerline.sinks.steps import read_steps, replace_steps
from ledgerline.sinks.writers import IncompleteBatchError
from ledgerline.sources import delivered as D

LANDED = T.StructType([
    T.StructField(D.LINE, T.StringType()), T.StructField(D.FILE, T.StringType()),
    T.StructField(D.BLOCK, T.LongType()), T.StructField(D.POS, T.LongType()),
    T.StructField(D.SIZE, T.LongType()), T.StructField("_load", T.StringType()),
    T.StructField(STEP, T.IntegerType())])


def delivered_steps(spark: SparkSession, root: str) -> dict[str, set[int]]:
    """The steps of which each feed has a folder with a file: one listing per feed, nothing is read."""
    folders, out = Folders(spark), {}
    for feed in FEEDS:
        found = folders.glob(f"{root.rstrip('/')}/{feed}/{STEP}=*/*")
        parts = [f.rsplit("/", 2)[1:] for f in found]
        out[feed] = {int(step[len(STEP) + 1:]) for step, file in parts
                     if file[0] not in "._" and step[len(STEP) + 1:].isdigit()}
    return out


def land_files(spark: SparkSession, src_root: str, dst_root: str,
               steps: Iterable[int] | None = None, load_id: str = "") -> dict[str, int]:
    """Copy the lines of the three feeds' files of ``steps`` (all delivered ones if ``None``).

    All or error: a step that lacks a feed stops the landing before anything is
    written. Each feed's steps are replaced as one commit, so landing a step again
    (a correction) leaves only its last delivery. Each task writes what it read:
    no exchange. Returns the landed lines per feed.
    """
    have = delivered_steps(spark, src_root)
    steps = sorted(set().union(*have.values()) if steps is None else {int(s) for s in steps})
    bad = [s for s in steps if any(s not in have[f] for f in FEEDS)]
    if bad:
        raise IncompleteBatchError(f"steps missing a feed (first 20): {bad[:20]}")
    out = {}
    for feed in FEEDS:
        base = f"{src_root.rstrip('/')}/{feed}"
        paths = [base] if len(steps) == len(have[feed]) else [f"{base}/{STEP}={s}" for s in steps]
        lines = D.read_lines(spark, paths, base=base)
        lines = lines.withColumn(STEP, F.col(STEP).cast("int")).withColumn("_load", F.lit(load_id))
        seen = Observation(f"landed-{feed}")
        replace_steps(lines.select(*LANDED.fieldNames()), f"{dst_root.rstrip('/')}/{feed}", steps,
                      cluster=False, observe=(seen, F.count(F.lit(1)).alias("lines")))
        out[feed] = seen.get["lines"]
    return out


def landed_lines(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The landed lines of a feed: text, place, load and step."""
    return read_steps(spark, f"{root.rstrip('/')}/{feed}", LANDED)


def rescued_feed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """A feed's lines typed by header name, with ``step`` and what did not fit.

    ``step`` is the batch, that is, the folder; a column of that name in the
    files is one more column that the schema does not ask for.
    """
    own = T.StructType([f for f in FEED_SCHEMAS[feed].fields if f.name != STEP])
    return D.rescue(landed_lines(spark, root, feed), own)


def typed_feed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The sound rows of a landed feed, with its schema and ``step``."""
    names = FEED_SCHEMAS[feed].fieldNames()
    names = names if STEP in names else names + [STEP]
    return D.sound(rescued_feed(spark, root, feed)).select(*names)


def malformed_values(rescued: DataFrame, keys: list[str]) -> DataFrame:
    """One row per field that failed: ``keys``, ``field``, ``value``.

    A line that was no record at all has a null field and the line as its value.
    """
    bad = D.quarantine(rescued)
    whole = F.struct(F.lit(None).cast("string").alias("field"), F.col(D.WHOLE).alias("value"))
    each = F.when(F.col(D.WHOLE).isNotNull(), F.array(whole)).otherwise(F.col(D.FAILED))
    return bad.select(*keys, F.inline(each))

"""What a job wrote, as data: files, data bytes and a digest of the content, in one pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.folders import Folders
from ledgerline.functions.columns import EVENT_TIME_BASE
from ledgerline.schemas import STEP
from ledgerline.sinks.steps import read_steps, replace_steps
from ledgerline.sources import delivered as D
from ledgerline.sources.files import file_inventory


def line_hash(line: Column) -> Column:
    """60 bits of a line's MD5, as a decimal that can be summed over any number of lines."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def output_files(spark: SparkSession, path: str, fmt: str = "csv", header: bool | None = None) -> DataFrame:
    """Per file with content below ``path``: ``file, file_size, header, lines, data_bytes, digest``.

    ``lines``, ``data_bytes`` (with line breaks) and ``digest`` (sum of the line
    hashes) leave out the header line, which CSV files have by default. Sums and
    digest do not depend on the order of lines or on how they are cut into files.
    """
    header = fmt == "csv" if header is None else header
    lines = D.read_lines(spark, path, recursive=True)
    size, h = F.octet_length(D.LINE).cast("bigint") + 1, line_hash(F.col(D.LINE))
    files = lines.groupBy(F.col(D.FILE).alias("file"), F.col(D.SIZE).alias("file_size")).agg(
        F.min(F.struct(D.BLOCK, D.POS, D.LINE)).alias("_first"), F.count(F.lit(1)).alias("lines"),
        F.sum(size).alias("data_bytes"), F.sum(h).alias("digest"))
    first = F.col(f"_first.{D.LINE}")
    if not header:
        return files.select("file", "file_size", F.lit(None).cast("string").alias("header"),
                            "lines", "data_bytes", "digest")
    return files.select(
        "file", "file_size", first.alias("header"), (F.col("lines") - 1).alias("lines"),
        (F.col("data_bytes") - F.octet_length(first) - 1).alias("data_bytes"),
        (F.col("digest") - line_hash(first)).cast("decimal(38,0)").alias("digest"))


def verify_output(spark: SparkSession, path: str, fmt: str = "csv", preview: int = 5) -> DataFrame:
    """One report on an output folder.

    ``files`` (with content), ``rows``, ``data_bytes``, ``digest``, ``header``, ``preview``
    (the first lines of the first file by name) and ``ok``: there are files with
    rows, and all have the same header.
    """
    listed = file_inventory(spark, path)
    listed = listed.where(~F.regexp_like(F.col("file_path"), F.lit(r".*/[_.][^/]*$")))
    files = listed.agg(F.count(F.lit(1))).first()[0]
    sums = output_files(spark, path, fmt).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("data_bytes"), F.lit(0)).alias("data_bytes"),
        F.coalesce(F.sum("digest"), F.lit(0)).cast("string").alias("digest"),
        F.min("header").alias("header"), F.count_distinct("header").alias("_headers"))
    first = listed.where("file_size > 0").agg(F.min("file_path")).first()[0]
    lines = [r[0] for r in spark.read.text(first).limit(preview).collect()] if first else []
    return sums.select(
        F.lit(files).cast("bigint").alias("files"), "rows", "data_bytes", "digest", "header",
        F.array(*[F.lit(x) for x in lines]).cast("array<string>").alias("preview"),
        ((F.col("rows") > 0) & (F.col("_headers") <= 1)).alias("ok"))


def step_folders(spark: SparkSession, root: str, as_of: str | datetime, days: int = 7,
                 base: str = EVENT_TIME_BASE) -> DataFrame:
    """The step folders below ``root`` and whether they expire as a whole.

    ``table`` (the folder above), ``step``, ``files``, ``bytes``, ``expired``: every event of
    the step's hour is before ``as_of - days`` (strictly, as for rows). A plan
    only; :func:`expire_steps` acts on it.
    """
    inv = file_inventory(spark, root)
    parts = F.regexp_extract("file_path", rf"([^/]+)/{STEP}=(\d+)/[^/_.][^/]*$", 1), \
        F.regexp_extract("file_path", rf"([^/]+)/{STEP}=(\d+)/[^/_.][^/]*$", 2)
    found = inv.select(parts[0].alias("table"), parts[1].alias("_step"), "file_size").where("table <> ''")
    folders = found.groupBy("table", F.col("_step").cast("int").alias(STEP)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
    cut = F.timestamp_add("DAY", F.lit(-days), F.lit(as_of).cast("timestamp_ntz"))
    ends = F.timestamp_add("HOUR", F.col(STEP) + 1, F.lit(base).cast("timestamp_ntz"))
    return folders.withColumn("expired", ends <= cut)


def expire_steps(spark: SparkSession, path: str, as_of: str | datetime, days: int = 7,
                 base: str = EVENT_TIME_BASE) -> list[int]:
    """Drop the expired step folders of the table at ``path`` in one commit; the steps dropped.

    Only step numbers reach the driver, one per folder.
    """
    path = path.rstrip("/")
    name = path.rsplit("/", 1)[1]
    plan = step_folders(spark, path, as_of, days, base).where(F.col("table") == name)
    gone = sorted(r[STEP] for r in plan.where("expired").select(STEP).collect())
    if gone and Folders(spark).exists(path):
        replace_steps(read_steps(spark, path).limit(0), path, gone)
    return gone

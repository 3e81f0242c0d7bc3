"""Schema drift between delivered files: the least type that holds each column's values.

Every value is put at the lowest place of a small lattice of types; a file's
column is the join of its values, the table's column the join of its files. Joins are a
bitwise or, so the whole answer is one partial aggregation over the lines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators._joins import join_bounded
from ledgerline.sources import delivered as D

#: Kinds of value, lowest first; a column's mask has the bit of each kind it holds.
KINDS = ("int", "bigint", "double", "boolean", "date", "timestamp", "string")
BIT = {k: 1 << i for i, k in enumerate(KINDS)}


def kind(value: Column) -> Column:
    """The bit of the lowest type that reads ``value``; 0 for a null."""
    text = F.trim(value)
    whole = F.regexp_like(text, F.lit(r"^[+-]?[0-9]+$"))
    return (F.when(value.isNull(), 0)
            .when(whole & text.try_cast("int").isNotNull(), BIT["int"])
            .when(whole & text.try_cast("bigint").isNotNull(), BIT["bigint"])
            .when(F.regexp_like(text, F.lit(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")),
                  BIT["double"])
            .when(F.lower(text).isin("true", "false"), BIT["boolean"])
            .when(F.regexp_like(text, F.lit(r"^\d{4}-\d\d-\d\d$")) & text.try_cast("date").isNotNull(),
                  BIT["date"])
            .when(F.regexp_like(text, F.lit(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d"))
                  & text.try_cast("timestamp_ntz").isNotNull(), BIT["timestamp"])
            .otherwise(BIT["string"]))


def joined(mask: Column) -> Column:
    """The least type above all kinds of a mask: int < bigint < double, date < timestamp, else string."""
    def within(*kinds: str) -> Column:
        return mask.bitwiseAND(F.lit(~sum(BIT[k] for k in kinds) & (1 << len(KINDS)) - 1)) == 0
    return (F.when(mask == 0, "void").when(within("int"), "int").when(within("int", "bigint"), "bigint")
            .when(within("int", "bigint", "double"), "double").when(within("boolean"), "boolean")
            .when(within("date"), "date").when(within("date", "timestamp"), "timestamp")
            .otherwise("string"))


def file_columns(lines: DataFrame, csv_options: Mapping[str, str] | None = None,
                 max_files: int = 100_000) -> DataFrame:
    """Per file and column of its header: ``file, column, mask, type, filled, rows``.

    A file's first line is its header. Lines with another number of fields than
    it are left to :func:`~ledgerline.sources.delivered.rescue` to report.
    """
    options = {**D.CSV, **(csv_options or {})}
    line = F.regexp_replace(D.LINE, "\\r$", "")
    first = lines.groupBy(D.FILE).agg(F.min(F.struct(D.BLOCK, D.POS, line.alias("l"))).alias("_first"))
    names = F.transform(F.split("_first.l", ","), lambda c: F.trim(F.regexp_replace(c, '^\\s*"|"\\s*$', "")))
    heads = first.select(F.col(D.FILE).alias("_head_file"), F.col("_first")[D.BLOCK].alias("_hb"),
                         F.col("_first")[D.POS].alias("_hp"), names.alias("_names"))
    sizes = {r["w"]: r["n"] for r in heads.groupBy(F.size("_names").alias("w")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    rows = join_bounded(lines.where(F.trim(line) != ""), heads, F.col(D.FILE) == F.col("_head_file"),
                        "inner", sum(sizes.values()), max_files)
    rows = rows.where((F.col(D.BLOCK) != F.col("_hb")) | (F.col(D.POS) != F.col("_hp")))
    parsed = [F.when(F.size("_names") == w, D.cells(line, w, options)) for w in sorted(sizes)]
    rows = rows.select(D.FILE, "_names", (F.coalesce(*parsed) if parsed else F.array()).alias("_cells"))
    cells = F.transform("_names", lambda n, i: F.struct(n.alias("column"), F.get("_cells", i).alias("v")))
    each = rows.where("_cells IS NOT NULL").select(F.col(D.FILE).alias("file"), F.inline(cells))
    out = each.groupBy("file", "column").agg(
        F.bit_or(kind(F.col("v"))).alias("mask"), F.count("v").alias("filled"),
        F.count(F.lit(1)).alias("rows"))
    return out.withColumn("type", joined(F.col("mask")))


def schema_drift(per_file: DataFrame) -> DataFrame:
    """Per column: ``column, type, seen, files, filled, rows``.

    ``type`` holds the values of all files; ``seen`` are the files' own types,
    sorted and comma-joined (several mean drift); ``files`` have the column.
    """
    return per_file.groupBy("column").agg(
        joined(F.bit_or("mask")).alias("type"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("seen"),
        F.count(F.lit(1)).alias("files"), F.sum("filled").alias("filled"), F.sum("rows").alias("rows"))

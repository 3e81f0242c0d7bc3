"""Exact deduplication by skew-safe combining.

Three steps, each comparing whole texts: (1) every task combines the equal
texts it holds, (2) what is left meets in (digest, salt) groups, (3) one winner
for each salt meets in the digest's group. A text that makes up a third of all
rows reaches step 3 as at most ``salts`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table, text_only

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def orderable(kind: T.DataType) -> bool:
    """Whether values of this type can be compared."""
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, text) -> largest id, rows; ``rows`` has doc_id, text and digest."""
    local = rows.withColumn("salt", F.spark_partition_id() % salts)
    # the partial aggregation of this groupBy is step 1, its final one step 2
    salted = local.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.repartition("digest").groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = SALTS,
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; of equal texts the largest doc_id stays. A
    null text counts as an empty one, and all empty texts form one group. A
    null doc_id never wins against another id; if a group has no id at all,
    keep_id is null and no row of it is kept. Rows that repeat both doc_id and
    text each count in group_size and are all marked like the one that stays
    (nothing tells them apart). No rows give no rows. Other columns of
    ``docs`` are ignored, whatever their names. Whole texts are compared in
    every step, so a ``digest`` that collides changes nothing but the speed.
    """
    rows = text_only(docs, id_col, text_col).withColumn("digest", digest(F.col("text")))
    groups = cut(_winners(rows, salts).groupBy("digest").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("texts")), "exact-groups")
    ids = rows.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256"))
    out = ids.join(groups.where("texts = 1").drop("texts"), "digest")
    clash = groups.where("texts > 1").select("digest")
    if clash.limit(1).count():  # digests of several texts: those rows are matched by text
        again = rows.join(clash, "digest", "left_semi")
        by_text = again.join(_winners(again, salts), ["digest", "text"]).select(
            "digest", "doc_id", sha256(F.col("text")).alias("text_sha256"),
            "keep_id", "group_size")
        out = out.unionByName(by_text)
    return out.select(
        "doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text.

    Same three steps; of rows that repeat doc_id as well, the one with the
    largest other columns stays. A null text is kept as null and counts as
    empty; a group without any doc_id keeps one row. Column order is unchanged.
    """
    rest = [c for c in docs.columns if c != text_col]
    first = [id_col] + [c for c in rest if c != id_col]
    rows = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(first)],
                 F.col(text_col).isNotNull().alias("present")).alias("_row"),
        (F.spark_partition_id() % salts).alias("_salt"))
    rows = rows.withColumn("_digest", sha256(F.col("_text")))
    # columns that have no order (maps) count by their text
    order = F.struct(*[F.col(f"_row.c{i}") if orderable(docs.schema[c].dataType) else
                       F.col(f"_row.c{i}").cast("string") for i, c in enumerate(first)], "_row.present")
    rows = rows.withColumn("_order", order)
    salted = rows.groupBy("_digest", "_salt", "_text").agg(
        F.max_by("_row", "_order").alias("_row"), F.max("_order").alias("_order"))
    won = salted.groupBy("_digest", "_text").agg(F.max_by("_row", "_order").alias("_row"))
    text = F.when(F.col("_row.present"), F.col("_text"))
    at = {c: F.col(f"_row.c{i}") for i, c in enumerate(first)}
    return won.select(*[(text if c == text_col else at[c]).alias(c) for c in docs.columns])


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM d
"""

QUERIES = {"op9_exact_dedup": op9_exact_dedup}
ORACLES = {"op9_exact_dedup": ORACLE}

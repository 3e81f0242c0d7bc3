"""The corpus pipeline: stages over ``documents``, each by one operator of ``ledgerline.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read back as the next one's ``docs``.
All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, table
from ledgerline.llm.decontaminate import drop_contaminated
from ledgerline.llm.exact_dedup import drop_exact_duplicates
from ledgerline.llm.near_dedup import drop_near_duplicates
from ledgerline.llm.pieces import encode_pieces, model_bytes
from ledgerline.llm.quality import fit_quality, keep_quality


#: Words that a benchmark item must have to remove documents.
LEAST_WORDS = 4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Rows with a null or empty text are scored like all others; an empty table
    gives an empty one; without labels nothing is rejected.
    """
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest doc_id.

    All null and empty texts are one group; repeated rows are copies like others.
    """
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (5-word shingles, similarity 0.8).

    It is the one with the smallest doc_id. Documents without words, and rows
    without doc_id, are in no group and stay.
    """
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go; null and empty texts stay.

    Items of fewer than ``LEAST_WORDS`` words are not looked for here: such a
    phrase stands in many clean documents.
    """
    items = table(spark, sf_dir, "benchmark")
    words = F.size(F.regexp_extract_all("text", F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+)")))
    return drop_contaminated(docs, items.where(words >= LEAST_WORDS))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its piece ids and the text decoded from them.

    Returns doc_id, lang, source, n_chars, n_tokens, ids, decoded; a null text
    has null ids, n_tokens 0 and a null decoded text.
    """
    docs = docs.select("doc_id", "lang", "source", "n_chars", "text")
    coded = encode_pieces(docs, model_bytes(), decoded_col="decoded")
    return coded.select("doc_id", "lang", "source", "n_chars",
                        F.greatest(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
                        "ids", "decoded")


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("pieces", pieces_stage),
]

#: The classifier, the near-duplicate search and the encoder cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

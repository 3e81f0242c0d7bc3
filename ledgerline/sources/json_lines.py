"""JSON lines of unknown schema in one read of the input, bad lines kept.

Each line becomes a VARIANT and is stored; the schema is aggregated from the
variants *while* they are written, so no pass over the input is spent on
inference. A line that is no JSON object is kept as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch_path


@dataclass
class JsonLines:
    """``rows`` typed by the aggregated schema, ``bad`` lines (``line``), and the counts of both."""

    rows: DataFrame
    bad: DataFrame
    n_rows: int
    n_bad: int


def inferred(told: str | None) -> T.StructType:
    """The schema that JSON inference gives for an aggregated variant schema.

    Decimals are doubles, fields that are null everywhere or of several kinds are text.
    """
    from pyspark.sql.types import _parse_datatype_string
    if not told or not told.startswith("OBJECT<"):
        return T.StructType([])
    out, at = [], 0
    # names may hold anything, so only the type words outside of back quotes are put in Spark's terms
    while at < len(told):
        if told[at] == "`":
            to = told.index("`", at + 1)
            while told[to:to + 2] == "``":
                to = told.index("`", to + 2)
            out.append(told[at:to + 1])
            at = to + 1
            continue
        to = told.find("`", at)
        to = len(told) if to < 0 else to
        out.append(told[at:to].replace("OBJECT<", "STRUCT<"))
        at = to

    def plain(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(plain(kind.elementType))
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return T.DoubleType()
        if isinstance(kind, (T.NullType, T.VariantType)):
            return T.StringType()
        return kind
    return plain(_parse_datatype_string("".join(out)))


def read_json_lines(spark: SparkSession, path: str) -> JsonLines:
    """The objects of JSON-lines files below ``path``, read once.

    Empty lines are neither rows nor bad. The variants are stored below the shared
    checkpoint folder; the result reads that copy, never the input again.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line").where(F.trim("line") != "")
    v = F.try_parse_json("line")
    lines = lines.withColumn("v", v)
    is_object = F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")), F.lit(False))
    # the text is stored only where it says something that the variant does not
    lines = lines.select(F.when(is_object, F.col("v")).alias("v"),
                         F.when(~is_object, F.col("line")).alias("line"))
    seen = Observation("json_lines")
    stored = scratch_path(spark, "json-lines")
    lines.observe(seen, F.schema_of_variant_agg("v").alias("told"), F.count("v").alias("rows"),
                  F.count("line").alias("bad")).write.parquet(stored)
    got = seen.get
    back = spark.read.schema(lines.schema).parquet(stored)

    def value(f: T.StructField) -> Column:
        kind = f.dataType.simpleString()
        quote = "'" if "'" not in f.name else '"'
        if quote in f.name:  # a path cannot hold both quotes
            return F.col("v").cast("map<string,variant>")[f.name].cast(kind).alias(f.name)
        return F.variant_get("v", f"$[{quote}{f.name}{quote}]", kind).alias(f.name)
    rows = back.where("line IS NULL").select(*[value(f) for f in inferred(got["told"]).fields])
    return JsonLines(rows, back.where("line IS NOT NULL").select("line"), got["rows"], got["bad"])

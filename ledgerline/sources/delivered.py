"""Text files as delivered: every line with its place, typed only when read.

:func:`read_lines` gives each line of a set of files with its file and place,
without a shuffle. :func:`rescue` types such lines *by header name*, file by
file, and keeps what does not fit: each field that fails its cast is listed
with its text, and a line that is no record at all is kept whole. So nothing is
lost between the files and the typed table, whatever the source sends.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators._joins import join_bounded

LINE = "line"
FILE, BLOCK, POS, SIZE = "_file", "_block", "_pos", "_file_size"
PLACE = (FILE, BLOCK, POS, SIZE)
FAILED, WHOLE = "_failed", "_whole_line"

#: A line break inside a value is not supported, as in Spark's CSV reader by default.
CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}


def read_lines(spark: SparkSession, paths: str | list[str], recursive: bool = False,
               base: str | None = None) -> DataFrame:
    """Each line (without its ``\\n``) and its place.

    ``_file``; ``_block``, where the part of the file that held it starts; ``_pos``,
    which ascends within the block; ``_file_size``. Ordered by (file, block,
    position) they give back the files (:func:`file_sums` tells that none is missing).
    Partition columns of the folders (below ``base``) are kept. Only a scan: no exchange.
    """
    reader = spark.read.option("lineSep", "\n")
    if base:
        reader = reader.option("basePath", base)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(paths)
    return lines.select(
        F.col("value").alias(LINE), *[c for c in lines.columns if c != "value"],
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POS), F.col("_metadata.file_size").alias(SIZE))


def cells(line: Column, width: int, options: Mapping[str, str]) -> Column:
    """The ``width`` fields of a CSV line; null if it has more or fewer."""
    names = [f"f{i}" for i in range(width)]
    row = F.from_csv(line, ", ".join(f"{c} string" for c in names) + ", _bad string", dict(options))
    # parsed once: as a lambda's argument the record is not cut into one parser per field
    return F.transform(F.array(row), lambda r: F.when(
        r["_bad"].isNull(), F.array(*[r[c] for c in names])))[0]


def headers(lines: DataFrame, names: Iterable[str]) -> DataFrame:
    """(_file, at): per file, where each of ``names`` stands in its header, from 0.

    A header is a line that names all of ``names``, each once, in any order and
    among other columns. Files without one are absent.
    """
    names = list(names)
    has = [F.contains(F.col(LINE), F.lit(n)) for n in names]
    found = lines.where(F.forall(F.array(*has), lambda x: x)).select(FILE, LINE)
    cells = F.transform(F.split(LINE, ","), lambda c: F.trim(F.regexp_replace(c, '^\\s*"|"\\s*$|\\r$', "")))
    found = found.withColumn("_cells", cells)

    def once(name: str) -> Column:
        return F.size(F.filter("_cells", lambda c: c == name)) == 1
    found = found.where(F.forall(F.array(*[once(n) for n in names]), lambda x: x))
    at = F.create_map(*[x for n in names for x in
                        (F.lit(n), F.array_position("_cells", n).cast("int") - 1)])
    return found.groupBy(FILE).agg(F.min_by(at, LINE).alias("at"), F.max(F.size("_cells")).alias("width"))


def rescue(lines: DataFrame, schema: T.StructType, max_files: int = 100_000,
           csv_options: Mapping[str, str] | None = None) -> DataFrame:
    """Typed columns of ``schema`` read by header name, ``_failed``, ``_whole_line`` and the place.

    ``_failed`` lists the fields whose text does not fit its type (the column is
    then null), empty for a sound row. ``_whole_line`` is set for a line that
    cannot be read as a record of its file (too many or too few fields, or a
    file without a header naming all columns); its columns are null. Empty
    fields are nulls, blanks around numbers are allowed, header lines (also
    repeated ones) and empty lines are no rows. Other columns of ``lines`` stay.

    Two scans of the lines: one for the headers, one for the rows. The header
    table (a row per file) is broadcast up to ``max_files`` files, counted.
    """
    options = {**CSV, **(csv_options or {})}
    names = schema.fieldNames()
    heads = headers(lines, names)
    sizes = {r["width"]: r["files"] for r in
             heads.groupBy("width").agg(F.count(F.lit(1)).alias("files")).collect()}
    heads = heads.withColumnRenamed(FILE, "_head_file")
    line = F.regexp_replace(LINE, "\\r$", "")
    rows = join_bounded(lines.where(F.trim(line) != ""), heads, F.col(FILE) == F.col("_head_file"),
                        "left", sum(sizes.values()), max_files)
    # each width of header (one, as a rule) has its own record type
    parsed = [F.when(F.col("width") == w, cells(line, w, options)) for w in sorted(sizes)]
    rows = rows.withColumn("_cells", F.coalesce(*parsed) if parsed else
                           F.lit(None).cast("array<string>"))
    is_header = F.forall(F.map_entries("at"), lambda e: F.get(F.col("_cells"), e["value"]) == e["key"])
    rows = rows.where(~F.coalesce(is_header, F.lit(False)))

    def text(name: str) -> Column:
        return F.get(F.col("_cells"), F.col("at")[name])

    def typed(f: T.StructField) -> Column:
        return text(f.name).try_cast(f.dataType)
    failed = F.filter(F.array(*[
        F.struct(F.lit(f.name).alias("field"),
                 F.when(typed(f).isNull(), text(f.name)).alias("value"))
        for f in schema.fields]), lambda x: x["value"].isNotNull())
    keep = [c for c in lines.columns if c != LINE and c not in names]
    return rows.select(*[typed(f).alias(f.name) for f in schema.fields], failed.alias(FAILED),
                       F.when(F.col("_cells").isNull(), F.col(LINE)).alias(WHOLE), *keep)


def sound(rescued: DataFrame) -> DataFrame:
    """The rows without any failure, without the columns that tell of them."""
    return rescued.where((F.size(FAILED) == 0) & F.col(WHOLE).isNull()).drop(FAILED, WHOLE)


def quarantine(rescued: DataFrame) -> DataFrame:
    """The rows with a failure: what could be typed, the failed fields, the place."""
    return rescued.where((F.size(FAILED) > 0) | F.col(WHOLE).isNotNull())


def file_sums(lines: DataFrame) -> DataFrame:
    """Per file: ``lines``, ``bytes`` of its lines with their breaks, ``file_size``, ``whole``.

    ``whole``: the lines make up the file (its last line may lack the break).
    """
    out = lines.groupBy(FILE, F.col(SIZE).alias("file_size")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length(LINE) + 1).alias("bytes"))
    over = F.col("bytes") - F.col("file_size")
    return out.withColumn("whole", over.isin(0, 1))


def with_line_index(stored: DataFrame, col: str = "line_index", max_runs: int = 1_000_000) -> DataFrame:
    """Add the 0-based number of each row over all files, in order of file name and place.

    ``stored`` must be a stored table (its ``_pos`` must not change between
    reads). A summary of one row per block of a file gives each block its
    offset; within a block ``_pos`` is consecutive where no row was filtered
    out after the scan, and counted by rank otherwise.
    """
    runs = stored.groupBy(FILE, BLOCK).agg(
        F.min(POS).alias("_first"), F.max(POS).alias("_last"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_run_file", "_run_block").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col(FILE).alias("_run_file"), F.col(BLOCK).alias("_run_block"), "_first",
        (F.col("_last") - F.col("_first") + 1 == F.col("_n")).alias("_dense"), "_n")
    gaps = runs.where("not _dense").limit(1).count()
    n_runs = runs.count()
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n", "_dense")
    cond = (F.col(FILE) == F.col("_run_file")) & (F.col(BLOCK) == F.col("_run_block"))
    joined = join_bounded(stored, runs, cond, "inner", n_runs, max_runs)
    inside = F.col(POS) - F.col("_first") if not gaps else \
        F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy(POS)) - 1
    return joined.withColumn(col, (F.col("_offset") + inside).cast("bigint")).drop(
        "_run_file", "_run_block", "_first", "_offset")

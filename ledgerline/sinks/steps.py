"""Replacing named steps of a step-partitioned table as one commit.

A run writes its rows aside, then a small log record names every step it
replaces: that record is the commit. Afterwards the step folders are swapped
one by one. A run that dies before the record leaves the old state (its staged
rows are dropped by the next run); one that dies after it leaves the new state:
readers see through the record (:func:`read_steps`), and the next run, or
:func:`recover`, finishes the swap. Every move can be repeated. A named step
without rows is gone afterwards. One run at a time may write a table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.folders import Folders
from ledgerline.schemas import STEP
from ledgerline.sinks.writers import write_batch

LOG, STAGED, OLD, NEW = "_log", "_staged", "_old", "new"


def _folder(step: int) -> str:
    return f"{STEP}={step}"


def _records(folders: Folders, path: str) -> list[dict]:
    names = [n for n in folders.names(f"{path}/{LOG}") if n.endswith(".json") and n[0] != "."]
    return [json.loads(folders.read(f"{path}/{LOG}/{n}")) for n in names]


def _swap(folders: Folders, path: str, record: dict) -> None:
    """One rename per folder that goes or comes; what is already done is told from the listings."""
    run, delivered = record["run"], set(record["delivered"])
    staged, old = f"{path}/{STAGED}/{run}", f"{path}/{OLD}/{run}"
    here, there = set(folders.names(path)), set(folders.names(staged))
    folders.make(old)
    for step in record["steps"]:
        name = _folder(step)
        comes = step in delivered and name in there
        if name in here and (comes or step not in delivered):
            folders.move(f"{path}/{name}", f"{old}/{name}")
        if comes:
            folders.move(f"{staged}/{name}", f"{path}/{name}")
    folders.delete(old)
    folders.delete(staged)
    folders.delete(f"{path}/{LOG}/{run}.json")


def recover(spark: SparkSession, path: str) -> int:
    """Finish committed runs and drop what runs left that never committed; how many were finished."""
    folders, path = Folders(spark), path.rstrip("/")
    records = _records(folders, path)
    for record in records:
        _swap(folders, path, record)
    for rest in (f"{path}/{STAGED}", f"{path}/{OLD}", *folders.glob(f"{path}.{NEW}-*")):
        if folders.exists(rest):
            folders.delete(rest)
    return len(records)


def replace_steps(df: DataFrame, path: str, steps: Iterable[int], fmt: str = "parquet",
                  **layout) -> dict:
    """Make ``steps`` of the table at ``path`` hold exactly the rows of ``df``.

    Rows of other steps are not written. Returns ``run``, ``steps`` and
    ``delivered`` (the steps with rows). ``layout`` goes to
    :func:`~ledgerline.sinks.writers.write_batch` (``cluster``, ``observe``, ...).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    steps = sorted({int(s) for s in steps})
    recover(spark, path)
    folders = Folders(spark)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    new = not folders.exists(path)
    staged = f"{path}.{NEW}-{run}" if new else f"{path}/{STAGED}/{run}"
    write_batch(df.where(F.col(STEP).isin(steps)), staged, mode="overwrite", fmt=fmt, **layout)
    found = set(folders.names(staged))
    record = {"run": run, "steps": steps, "delivered": [s for s in steps if _folder(s) in found]}
    if new:  # the whole table appears by one rename
        folders.move(staged, path)
        return record
    folders.write_whole(f"{path}/{LOG}/{run}.json", json.dumps(record))
    _swap(folders, path, record)
    return record


def read_steps(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """The committed state of the table, also while a swap is unfinished.

    ``schema`` (with ``step``) is needed only for a table that may hold no step.
    """
    folders, path = Folders(spark), path.rstrip("/")
    here = [n for n in folders.names(path) if n.startswith(f"{STEP}=")]
    at = dict.fromkeys(here, path)
    for record in _records(folders, path):
        staged = f"{path}/{STAGED}/{record['run']}"
        there = set(folders.names(staged))
        for step in record["steps"]:
            name = _folder(step)
            if step not in record["delivered"]:
                at.pop(name, None)
            elif name in there:
                at[name] = staged
            else:
                at[name] = path
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    out = None
    for base in sorted(set(at.values())):
        some = sorted(n for n, b in at.items() if b == base)
        # the table as it stands needs no list of its folders
        paths = [base] if some == sorted(here) and base == path else [f"{base}/{n}" for n in some]
        part = reader.option("basePath", base).load(paths)
        out = part if out is None else out.unionByName(part)
    if out is None:
        if schema is None:
            raise FileNotFoundError(f"no step below {path}")
        out = spark.createDataFrame([], schema)
    return out

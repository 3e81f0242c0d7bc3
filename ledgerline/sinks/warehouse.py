"""A warehouse of Parquet tables behind Spark's data source API, released as a whole.

``df.write.format("ledger_warehouse")`` takes the options a warehouse connector
takes (``dbtable`` and where it is). Each task writes a file of its own; the table
of a release is what the commit message names, so files of tasks that failed or ran twice
are never part of it, and an aborted write removes what it wrote (a task that outlives
the abort may leave a file that nothing names; :func:`drop_old_releases` takes
it). A release
becomes current, with all its tables or not at all, when :func:`publish` writes
the one small file that names it; readers go through that file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ledgerline.folders import Folders
from ledgerline.sinks.writers import write_warehouse

FORMAT = "ledger_warehouse"
#: Options that must be given: where the warehouse is, the table, the release it belongs to.
NEEDED = ("path", "dbtable", "release")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it; executors and driver use the same."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.table, self.release = (options[n] for n in NEEDED)
        self.root = self.root.rstrip("/")
        self.ddl = schema.json()

    @property
    def folder(self) -> str:
        return f"{self.root}/releases/{self.release}/{self.table}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext
        fs, folder = _store(self.folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        out, rows = None, 0
        try:
            for batch in batches:
                if out is None:
                    fs.create_dir(folder)
                    out = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=fs)
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                fs.delete_file(f"{folder}/{name}")
            raise
        if out is None:  # a task without rows
            return Written("", 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = _store(self.folder)
        found = [m for m in messages if m is not None and m.file]
        text = json.dumps({"schema": self.ddl, "files": sorted(m.file for m in found),
                           "rows": sum(m.rows for m in found)})
        fs.create_dir(folder)
        with fs.open_output_stream(f"{folder}.json") as out:
            out.write(text.encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = _store(self.folder)
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class WarehouseSource(DataSource):
    """``format("ledger_warehouse")`` with ``path``, ``dbtable`` and ``release``; overwrite only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        missing = [n for n in NEEDED if not self.options.get(n)]
        if missing:
            raise ValueError(f"{FORMAT}: missing options {missing}")
        if not overwrite:
            raise ValueError(f"{FORMAT}: a release's table is written once, with mode overwrite")
        if not all(c.isalnum() or c in "_-." for c in self.options["dbtable"] + self.options["release"]):
            raise ValueError(f"{FORMAT}: dbtable and release may hold letters, digits, _ - . only")
        return _Writer(dict(self.options), schema)


def new_release() -> str:
    return f"r{uuid.uuid4().hex}"


def to_release(spark: SparkSession, root: str, release: str) -> Callable[[DataFrame, str], None]:
    """A publisher for the gold job: each table becomes part of ``release``, not yet current."""
    spark.dataSource.register(WarehouseSource)
    return lambda df, name: write_warehouse(df, name, {"path": root, "release": release}, FORMAT)


def _current(folders: Folders, root: str) -> tuple[int, dict | None]:
    names = [n for n in folders.names(f"{root}/current") if n.endswith(".json") and n[0] != "."]
    if not names:
        return 0, None
    return int(names[-1][:-5]), json.loads(folders.read(f"{root}/current/{names[-1]}"))


def publish(spark: SparkSession, root: str, release: str, tables: Iterable[str]) -> int:
    """Make ``release`` the current one if it has all ``tables``; the number of the publication.

    One rename: readers see the tables of the release before or those of this
    one, never some of each. A release that lacks a table is refused.
    """
    folders, root, tables = Folders(spark), root.rstrip("/"), sorted(tables)
    lacking = [t for t in tables if not folders.exists(f"{root}/releases/{release}/{t}.json")]
    if lacking:
        raise RuntimeError(f"release {release} lacks {lacking}; nothing was published")
    number = _current(folders, root)[0] + 1
    folders.write_whole(f"{root}/current/{number:012d}.json",
                        json.dumps({"release": release, "tables": tables}))
    return number


def drop_old_releases(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove releases that the last ``keep`` publications do not name; none may be in the making."""
    folders, root = Folders(spark), root.rstrip("/")
    names = [n for n in folders.names(f"{root}/current") if n.endswith(".json") and n[0] != "."]
    kept = {json.loads(folders.read(f"{root}/current/{n}"))["release"] for n in names[-keep:]}
    gone = [r for r in folders.names(f"{root}/releases") if r not in kept]
    for n in names[:-keep]:
        folders.delete(f"{root}/current/{n}")
    for release in gone:
        folders.delete(f"{root}/releases/{release}")
    return gone


def read_warehouse(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current release: exactly the files its commit names."""
    folders, root = Folders(spark), root.rstrip("/")
    now = _current(folders, root)[1]
    if now is None or table not in now["tables"]:
        raise LookupError(f"no published table {table}")
    where = f"{root}/releases/{now['release']}/{table}"
    told = json.loads(folders.read(f"{where}.json"))
    schema = StructType.fromJson(json.loads(told["schema"]))
    if not told["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{where}/{f}" for f in told["files"]])

"""Folders and small files on whatever storage a path names, through Spark's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folders:
    """Listing, moving and deleting of folders, and small files that appear as a whole."""

    def __init__(self, spark: SparkSession):
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._systems = {}

    def _at(self, path: str):
        where = self._fs.Path(path)
        # scheme and authority, as far as the path has them
        store = "/".join(path.split("/", 3)[:3]) if "://" in path else path.split("/", 1)[0]
        if store not in self._systems:
            self._systems[store] = where.getFileSystem(self._conf)
        return self._systems[store], where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def glob(self, pattern: str) -> list[str]:
        """Paths that match, sorted; one listing call whatever their number."""
        fs, where = self._at(pattern)
        found = fs.globStatus(where)
        paths = self._fs.FileUtil.stat2Paths(found) if found else []
        return sorted(p.toString() for p in paths)

    def names(self, path: str) -> list[str]:
        """Names of the entries of a folder, sorted; none if it does not exist."""
        return sorted(p.rsplit("/", 1)[1] for p in self.glob(f"{path.rstrip('/')}/*"))

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def make(self, path: str) -> None:
        fs, where = self._at(path)
        fs.mkdirs(where)

    def move(self, source: str, target: str) -> None:
        """Rename; the target's parent must exist, the target must not."""
        fs, a = self._at(source)
        if not fs.rename(a, self._fs.Path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_whole(self, path: str, text: str) -> None:
        """A new small file that is there as a whole or not at all (written aside, then renamed)."""
        folder, name = path.rsplit("/", 1)
        aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        fs, where = self._at(aside)
        stream = fs.create(where, False)  # makes the folder too
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(aside, path)

"""A commit log: one marker file per version, created only if it does not exist.

Data is written first, into folders of its own; the marker names them.  Of two
writers that start from the same version one commits and the other fails with
:class:`CommitConflict`.  (The guarantee is the storage's: creating a file
exclusively is atomic on HDFS and local disks; an object store needs a
committer with the same property.)
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed the version this one was about to write."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder ``staged`` in the place of ``target`` (which is removed first)."""
    new, fs = _path(spark, staged)
    old, _ = _path(spark, target)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise RuntimeError(f"could not move {staged} to {target}")


class CommitLog:
    """Markers ``<root>/_commits/<version>``, each one line of JSON."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_commits"

    def entries(self) -> list[tuple[int, dict | None]]:
        """(version, content) in order; None for a marker whose writer died before it was filled."""
        p, fs = _path(self.spark, self.folder)
        if not fs.exists(p):
            return []
        out = []
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.isdigit():
                stream = fs.open(status.getPath())
                try:
                    text = bytes(stream.readAllBytes()).decode()
                finally:
                    stream.close()
                out.append((int(name), json.loads(text) if text.endswith("\n") else None))
        return sorted(out, key=lambda e: e[0])

    def commit(self, version: int, content: dict) -> None:
        p, fs = _path(self.spark, f"{self.folder}/{version:09d}")
        try:
            out = fs.create(p, False)
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            raise CommitConflict(f"version {version} in {self.folder} is already committed") from e
        out.write(bytearray((json.dumps(content) + "\n").encode()))
        out.close()

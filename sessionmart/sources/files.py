"""Folders of the store that Spark reads (any Hadoop file system): existence, and moves that happen all or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


class Store:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def matches(self, pattern: str) -> bool:
        return bool(self._fs.globStatus(self._path(pattern)))

    def rename(self, old: str, new: str) -> None:
        parent = self._path(new).getParent()
        if parent is not None:
            self._fs.mkdirs(parent)
        if self._fs.exists(self._path(new)) or not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def exchange(self, moves: Sequence[tuple[str, str]]) -> None:
        """All renames (old, new) in order; if one fails, those before it are undone and the error is raised."""
        done: list[tuple[str, str]] = []
        try:
            for old, new in moves:
                self.rename(old, new)
                done.append((old, new))
        except Exception:
            for old, new in reversed(done):
                self.rename(new, old)
            raise

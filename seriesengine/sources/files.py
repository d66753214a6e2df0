"""Folders and files of any store that Spark reads: names, sizes, moves.

Only names go through the driver, never content.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs
        self._gateway = context._gateway
        self._conf = context._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._fs.makeQualified(self._hadoop.Path(path))

    def qualified(self, path: str) -> str:
        """The path with its scheme."""
        return self._path(path).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def bytes(self, path: str) -> int:
        """Size of a file or of all files of a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def names(self, folder: str, prefix: str = "") -> list[str]:
        found = (f.getPath().getName() for f in self._fs.listStatus(self._path(folder)))
        return sorted(n for n in found if n.startswith(prefix))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename to a name that is free."""
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def move_over(self, source: str, target: str) -> None:
        """Rename a file over the file that is there."""
        over = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        over[0] = getattr(self._hadoop, "Options$Rename").OVERWRITE
        place = self._path(target)
        context = self._hadoop.FileContext.getFileContext(place.toUri(), self._conf)
        context.rename(self._path(source), place, over)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

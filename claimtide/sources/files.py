"""Files and folders in whatever store Spark reads, by Hadoop's own interface."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Store:
    """The store that a path lies in. It outlives the session, as long as the process runs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._gateway = spark.sparkContext._gateway
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str) -> JavaObject:
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [f.getPath().getName() for f in self._files.listStatus(self._path(folder))]

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._files.open(self._path(path))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Writes the text beside and renames it into place: a reader sees the old or the new one."""
        beside = f"{path}.next"
        stream = self._files.create(self._path(beside), True)
        try:
            stream.writeUTF(text)
        finally:
            stream.close()
        rename = getattr(self._hadoop, "Options$Rename")
        over = self._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        place = self._files.makeQualified(self._path(path))
        context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self._conf)
        context.rename(self._files.makeQualified(self._path(beside)), place, over)

    def version(self, path: str) -> tuple[int, int, int]:
        """Bytes, files and last change of a table's files: other ones mean that it was rewritten."""
        found = self._files.getContentSummary(self._path(path))
        return found.getLength(), found.getFileCount(), self._files.getFileStatus(self._path(path)).getModificationTime()

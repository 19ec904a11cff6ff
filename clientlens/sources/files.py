"""File-system steps that tables kept by several writes need, through the
file system that Spark itself uses for the path (HDFS, object stores, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Names, small texts and removal under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def publish_text(self, name: str, text: str) -> None:
        """A new file that appears whole or not at all: written under another
        name, then renamed. An existing one is an error."""
        temp = self._path(f"{name}.unfinished")
        stream = self._fs.create(temp, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(self._path(name)) or not self._fs.rename(temp, self._path(name)):
            raise FileExistsError(self.path(name))

    def remove(self, name: str) -> None:
        """Remove a file or a folder; a missing one is fine."""
        self._fs.delete(self._path(name), True)

"""Listing, creating and deleting paths on whatever file system Spark is reading."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def names(self) -> list[str]:
        if not self._fs.exists(self._at()):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at()))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._at(*parts))

    def is_folder(self) -> bool:
        return self._fs.getFileStatus(self._at()).isDirectory()

    def create_text(self, name: str, content: str) -> None:
        """Write a new small file; an existing one is an error, never replaced."""
        out = self._fs.create(self._at(name), False)
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()

    def modified(self, name: str) -> int:
        """When a file was written, in milliseconds."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime()

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read_json(self, name: str) -> dict:
        return json.loads(self.read_text(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

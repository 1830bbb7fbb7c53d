"""Small file operations of the driver on any file system that Spark reads, with Spark's own credentials."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one of that name already."""
        system, at = self._at(path)
        try:
            out = system.create(at, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, path: str) -> str:
        system, at = self._at(path)
        stream = system.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        system, at = self._at(folder)
        return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []

    def delete(self, path: str) -> None:
        system, at = self._at(path)
        system.delete(at, True)

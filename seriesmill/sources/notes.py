"""Small values in a folder of the shared store, replaced in one step."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def path_of(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, name: str) -> bool:
    path, files = path_of(spark, name)
    return files.delete(path, True)


class Note:
    """A JSON value with numbered versions, one file each; the highest number is the value.

    A version is written beside its name and renamed, so that a reader finds a whole value or the one
    before. A writer that another one has overtaken is refused.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.version, self.value = self._last()

    def _versions(self) -> list[int]:
        path, files = path_of(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = (status.getPath().getName() for status in files.listStatus(path))
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _last(self) -> tuple[int, Any]:
        versions = self._versions()
        if not versions:
            return 0, None
        path, files = path_of(self.spark, f"{self.folder}/{versions[-1]}.json")
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return versions[-1], json.loads(text)

    def write(self, value: Any) -> None:
        new, files = path_of(self.spark, f"{self.folder}/{self.version + 1}.json")
        draft, _ = path_of(self.spark, f"{self.folder}/{uuid.uuid4().hex}.draft")
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        if files.exists(new) or not files.rename(draft, new):
            files.delete(draft, False)
            raise RuntimeError(f"{self.folder} has another writer")
        self.version, self.value = self.version + 1, value
        # the one before stays for readers that have just listed it
        if self.version > 2:
            files.delete(path_of(self.spark, f"{self.folder}/{self.version - 2}.json")[0], False)

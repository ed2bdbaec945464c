"""Numbered manifests of a folder of tables; what readers see changes by one rename."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


class ConcurrentLoad(RuntimeError):
    """Another load has been published since this one began."""


class Versions:
    """``<folder>/_versions/<number>.json``, each a whole state; the highest number is the current one."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = f"{folder}/_versions"

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def current(self) -> tuple[int, dict]:
        """(number, state); (0, {}) before the first publication."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        files = self._path().getFileSystem(conf)
        if not files.exists(self._path()):
            return 0, {}
        names = [s.getPath().getName() for s in files.listStatus(self._path())]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return 0, {}
        newest = max(numbers)
        text = self.spark.read.text(f"{self.folder}/{newest:012d}.json", wholetext=True).first()[0]
        return newest, json.loads(text)

    def publish(self, number: int, state: dict) -> None:
        """Make ``state`` the version ``number``; raises when there is one already."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        staged, final = self._path(f"_{uuid.uuid4().hex}"), self._path(f"{number:012d}.json")
        files = staged.getFileSystem(conf)
        out = files.create(staged)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        # unlike FileSystem.rename, this fails when the target exists
        keep = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), conf).rename(staged, final, keep)
        except Exception as error:
            files.delete(staged, False)
            if "FileAlreadyExists" in str(error) or isinstance(error, PySparkException):
                raise ConcurrentLoad(f"version {number} of {self.folder} was published by another load") from error
            raise

"""Where fetched pages land: a local folder, or any file system that Spark reads, so that executors see the pages."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession


class LocalStore:
    """Files of this machine; enough where driver and executors share its folders."""

    def exists(self, path: str) -> bool:
        return Path(path).exists()

    def read(self, path: str) -> str:
        return Path(path).read_text(encoding="utf-8")

    def write(self, path: str, text: str) -> None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")

    def names(self, folder: str) -> list[str]:
        return sorted(p.name for p in Path(folder).glob("*")) if Path(folder).exists() else []

    def read_json(self, path: str):
        return json.loads(self.read(path))

    def write_json(self, path: str, value) -> None:
        self.write(path, json.dumps(value, indent=2))


class HadoopStore(LocalStore):
    """Files of the store that a path's scheme names, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        fs, place = self._at(path)
        return fs.exists(place)

    def read(self, path: str) -> str:
        fs, place = self._at(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, place = self._at(path)
        stream = fs.create(place, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        fs, place = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

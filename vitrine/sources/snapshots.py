"""Versioned tables: data folders that never change, and manifests that name the folders of each version.

A version exists once its manifest does, and a manifest is created under a number that nobody else can take again:
a writer that fails leaves the version before it readable, and of two writers that build on the same version one wins.
Appending adds a folder to those of the newest version, replacing starts with a new one. Old versions stay readable.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer published first."""


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log = f"{self.path}/_versions"

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _numbers(self) -> list[int]:
        fs, where = self._hadoop(self._log)
        if not fs.exists(where):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())

    def _manifest(self, number: int) -> dict | None:
        """The manifest of a version; None where its writer died before the end."""
        fs, where = self._hadoop(f"{self._log}/{number:012d}")
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("\n") else None

    def versions(self) -> list[tuple[int, dict]]:
        """(number, manifest) of all versions, oldest first. A manifest holds folder names, not rows."""
        read = ((n, self._manifest(n)) for n in self._numbers())
        return [(n, m) for n, m in read if m is not None]

    def newest(self) -> int:
        """The number of the newest version, 0 for none."""
        for number in reversed(self._numbers()):
            if self._manifest(number) is not None:
                return number
        return 0

    def read(self, version: int | None = None, as_of: float | None = None) -> DataFrame:
        """The newest version, one by number, or the newest one that was there at a time (epoch seconds)."""
        found = [(n, m) for n, m in self.versions() if (version is None or n == version) and (as_of is None or m["written_at"] <= as_of)]
        if not found:
            raise LookupError(f"no such version of {self.path}")
        manifest = found[-1][1]
        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in manifest["folders"]])

    def replace(self, df: DataFrame, expected: int | None = None) -> int:
        """Publish ``df`` as the whole table; it may read the table itself. Returns the version."""
        return self._write(df, False, expected)

    def append(self, df: DataFrame, expected: int | None = None) -> int:
        """Publish the newest version and ``df``. With ``expected``, only if that is still the newest version."""
        return self._write(df, True, expected)

    def _write(self, df: DataFrame, keep: bool, expected: int | None) -> int:
        base = self.newest()
        if expected is not None and base != expected:
            raise Conflict(f"version {base} is newer than {expected}")
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        while True:
            # The number comes first: whatever is published after this look takes it, and the attempt fails.
            number = max(self._numbers(), default=0) + 1
            base = self.newest()
            if expected is not None and base != expected:
                raise Conflict(f"another writer published after version {expected}")
            before = self._manifest(base) if base else None
            folders = [*before["folders"], folder] if keep and before else [folder]
            schema = before["schema"] if keep and before else json.loads(df.schema.json())
            if self._publish(number, {"folders": folders, "schema": schema, "written_at": time.time()}):
                return number

    def _publish(self, number: int, manifest: dict) -> bool:
        """Create a manifest; False when its number is taken."""
        fs, where = self._hadoop(f"{self._log}/{number:012d}")
        try:
            stream = fs.create(where, False)  # refuses an existing file
        except Py4JJavaError:
            if fs.exists(where):
                return False
            raise
        try:
            stream.write((json.dumps(manifest) + "\n").encode())
        finally:
            stream.close()
        return True

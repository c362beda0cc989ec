"""Stored tables: Parquet folders ``base/<schema>/<table>`` with declared schemas.

A table that is replaced keeps its versions side by side (``snapshots``), so a write
that fails leaves the version before it in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import conform
from .snapshots import Snapshots


class Tables:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, schema: str, name: str) -> str:
        return f"{self.base}/{schema}/{name}"

    def snapshots(self, schema: str, name: str) -> Snapshots:
        """The versions of a table that is replaced; an append-only log is a plain folder."""
        return Snapshots(self.spark, self.path(schema, name))

    def read(self, schema: str, name: str, columns: list[str] | None = None, declared: str | None = None) -> DataFrame:
        versions = self.snapshots(schema, name)
        if versions.newest():
            df = versions.read()
            df = conform(df, declared) if declared is not None else df
        else:
            reader = self.spark.read.schema(declared) if declared is not None else self.spark.read
            df = reader.parquet(self.path(schema, name))
        return df.select(*columns) if columns else df

    def append(self, df: DataFrame, schema: str, name: str, declared: str | None = None, stamp: str | None = None) -> None:
        """Add rows, optionally stamped with the write time in column ``stamp``."""
        if stamp:
            df = df.withColumn(stamp, F.current_timestamp())
        df = conform(df, declared) if declared is not None else df
        versions = self.snapshots(schema, name)
        if versions.newest():
            versions.append(df)
        else:
            df.write.mode("append").parquet(self.path(schema, name))

    def replace(self, df: DataFrame, schema: str, name: str, declared: str | None = None) -> None:
        """Publish a new version of a table; its schema may change, and ``df`` may read the version before."""
        self.snapshots(schema, name).replace(conform(df, declared) if declared is not None else df)

    def append_events(self, df: DataFrame, schema: str, name: str, ts: str = "event_ts") -> None:
        """Add log rows partitioned by day, so date filters skip whole folders."""
        dated = df.withColumn("event_date", F.to_date(ts))
        dated.write.mode("append").partitionBy("event_date").parquet(self.path(schema, name))

    def read_events(self, schema: str, name: str, first_day, last_day=None) -> DataFrame:
        df = self.spark.read.parquet(self.path(schema, name)).where(F.col("event_date") >= F.lit(first_day).cast("date"))
        return df if last_day is None else df.where(F.col("event_date") <= F.lit(last_day).cast("date"))

"""Helpers shared by the operators: stored tables, distributed running sums, bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import work_dir

SLICE_BYTES = 1 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several plans read to the shared work folder, and read it back.

    The written rows survive a lost executor, and what was not deterministic (row
    numbers, partition numbers) is fixed from here on.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_sum(df: DataFrame, order: list[Column], value: Column, purpose: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over all rows that come earlier in ``order``.

    The rows are range-partitioned, so a hot leading column spreads over many
    partitions. Each range is summed by itself and shifted by the totals of the
    earlier ranges; that table has one row per partition, so its broadcast is
    bounded by the number of partitions whatever the input. Rows that are equal
    in ``order`` come in any order among themselves.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = {f"_k{i}": c for i, c in enumerate(order)}
    tagged = df.withColumns(keys | {"_v": value}).repartitionByRange(n, *keys)
    ranged = stored(tagged.withColumn("_part", F.spark_partition_id()), purpose)
    totals = ranged.groupBy("_part").agg(F.sum("_v").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .join(F.broadcast(shifts), "_part")
        .withColumn("before", F.col("_inside") + F.col("_shift"))
        .drop("_part", "_inside", "_shift", "_v", *keys)
    )


def numbered(df: DataFrame, order: list[str], purpose: str, name: str = "_number") -> DataFrame:
    """Adds a number from 0 without gaps in the order of ``order``, and writes the rows.

    Like ``running_sum`` it numbers ranges, so a group that leads the order, however large, spreads
    over many tasks. Rows that are equal in ``order`` come in any order among themselves, once and
    for all, since the rows are read back from the written table.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), purpose)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    shifts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    counted = ranged.withColumn("_inside", inside).join(F.broadcast(shifts), "_part")
    return stored(counted.withColumn(name, F.col("_inside") + F.col("_shift") - 1).drop("_part", "_inside", "_shift"), f"{purpose}-numbers")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows with about ``limit`` bytes of text, so that working memory does not
    follow the batch size. A single longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_fields(first: StructField, ddl: str) -> StructType:
    """The schema of a first field and the fields of ``ddl``."""
    return StructType([first, *StructType.fromDDL(ddl).fields])


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings; null is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows whose id and text hash are in ``kept`` (``_kept_id``, ``_kept_hash``), each pair once, all columns.

    The join's partitioning by id serves the numbering of repeated rows as well.
    """
    tagged = docs.select(F.struct("*").alias("_all"), F.col(id_col).alias("_by"), F.xxhash64(text_col).alias("_text_hash"))
    found = tagged.join(kept, F.col("_by").eqNullSafe(F.col("_kept_id")) & (F.col("_text_hash") == F.col("_kept_hash")), "left_semi")
    number = F.row_number().over(Window.partitionBy("_by", "_text_hash").orderBy(F.lit(0)))
    return found.withColumn("_number", number).where("_number = 1").select("_all.*")

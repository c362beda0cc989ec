"""A change feed folded into a table of vectors: upserts and deletes by sequence number, in whatever order they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructType

from .logs import _drain, _folder

#: Sequence numbers lie below this, so that number and kind of a change fit in one long.
LIMIT = 2**62


def _ordered(changes: DataFrame, key: str) -> DataFrame:
    """Adds ``_order``, which grows with ``seq`` and puts a delete behind an upsert of the same number; null for a bad change."""
    good = F.col(key).isNotNull() & F.col("seq").between(-LIMIT, LIMIT - 1) & F.col("op").isin("upsert", "delete")
    order = F.shiftleft(F.col("seq").cast("long"), 1) + (F.col("op") == "delete").cast("long")
    return changes.withColumn("_order", F.when(good, order))


def newest_changes(changes: DataFrame, key: str) -> DataFrame:
    """The last change of each key, with ``_order``; bad changes are left out.

    Orders fold where the rows are. Of upserts with the same number the one whose row has the least hash counts, so repeated
    deliveries count once and a rerun agrees.
    """
    columns = changes.columns
    good = _ordered(changes, key).where("_order IS NOT NULL")
    last = good.groupBy(key).agg(F.max("_order").alias("_order"))
    same = good.join(last, [key, "_order"], "left_semi")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*columns)))
    return same.withColumn("_nth", nth).where("_nth = 1").select(*columns, "_order")


def apply_changes(changes: DataFrame, base: str, embed: Callable[[DataFrame], DataFrame], vectors: StructType, key: str) -> DataFrame:
    """Folds all changes a stream holds now into the table below ``base``; returns ``current_vectors``.

    ``changes`` has ``key``, ``seq``, ``op`` ('upsert' or 'delete') and what the model reads; ``embed(upserts)`` gives rows of the
    schema ``vectors`` (``key`` among them, each at most once) and is asked only for upserts newer than all that is known of their key. A delete leaves a
    tombstone, so an older upsert that comes later does not bring the key back; so does an upsert that the model leaves out. A
    change with the number of a known one counts only if it is a delete after an upsert. Changes with a null key or number, a
    number of 2**62 or more or another ``op`` go to ``rejected_changes``.

    A micro-batch owns one folder per table, so a replayed one replaces its own output.
    """
    spark = changes.sparkSession
    state = _state_schema(vectors)

    def fold(batch: DataFrame, batch_id: int) -> None:
        _ordered(batch, key).where("_order IS NULL").drop("_order").write.mode("overwrite").parquet(f"{base}/rejected/batch={batch_id}")
        newest = newest_changes(batch, key)
        slim = _folder(spark, f"{base}/state", state).where(F.col("batch") < batch_id).select(key, "_order")
        known = slim.join(newest.select(key), key, "left_semi").groupBy(key).agg(F.max("_order").alias("_known"))
        fresh = newest.join(known, key, "left").where("_known IS NULL OR _order > _known").drop("_known")
        embedded = embed(fresh.where("op = 'upsert'").drop("seq", "op", "_order"))
        rows = fresh.select(key, "_order").join(embedded.withColumn("_live", F.lit(True)), key, "left")
        done = rows.withColumn("_live", F.coalesce("_live", F.lit(False))).select(*[f.name for f in state.fields if f.name != "batch"])
        done.write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")

    _drain(changes, fold, f"{base}/checkpoint")
    return current_vectors(spark, base, vectors, key)


def _state_schema(vectors: StructType) -> StructType:
    return StructType([*vectors.fields]).add("_order", LongType()).add("_live", "boolean").add("batch", LongType())


def current_vectors(spark: SparkSession, base: str, vectors: StructType, key: str) -> DataFrame:
    """The vectors of keys whose last change is an upsert, with its ``seq``; empty before the first change.

    Only keys and orders are folded; the vectors move once.
    """
    state = _folder(spark, f"{base}/state", _state_schema(vectors))
    last = state.groupBy(key).agg(F.max("_order").alias("_order"))
    live = state.where("_live").join(last, [key, "_order"], "left_semi")
    return live.select(*vectors.names, F.shiftright("_order", 1).alias("seq"))


def rejected_changes(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """Changes that could not be applied, with the ``batch`` that brought them."""
    return _folder(spark, f"{base}/rejected", StructType([*schema.fields]).add("batch", LongType()))

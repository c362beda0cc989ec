"""Batch inference around pluggable models, and checks of what they produce.

A model is a function from an iterator of pandas batches to an iterator of
pandas batches: it loads once per task and sees every row it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ..functions import vectors as V
from ..functions.scalars import box_area_fraction, detection_id
from .skew import rank_in_groups

#: Rows that a model is given at a time: what it makes of them is held beside the batch that Spark sends.
MODEL_ROWS = 512

Model = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def pending(items: DataFrame, existing: DataFrame, encoder_uri: str, key: str) -> DataFrame:
    """Items without a vector of this encoder."""
    done = existing.where(F.col("encoder_uri") == encoder_uri).select(key)
    return items.join(done, key, "left_anti")


def in_small_batches(model: Model, schema: StructType, rows: int = MODEL_ROWS):
    """The model as a function of Arrow batches that gives it ``rows`` rows at a time; it still loads once per task and sees every row."""
    fields = to_arrow_schema(schema)

    def run(batches):
        given = (batch.slice(start, rows).to_pandas() for batch in batches for start in range(0, batch.num_rows, rows))
        for made in model(given):
            yield pa.RecordBatch.from_pandas(made, schema=fields, preserve_index=False)

    return run


def embed_incremental(
    items: DataFrame,
    existing: DataFrame,
    encoder: Model,
    encoder_uri: str,
    key: str,
    payload: list[str],
    partitions: int | None = None,
) -> DataFrame:
    """New vectors ``(key, embedding, encoder_uri)`` for what ``existing`` lacks.

    The encoder gets ``key`` and ``payload`` only and leaves out what it cannot
    read. ``partitions`` spreads few large items over more tasks.
    """
    todo = pending(items, existing, encoder_uri, key).select(key, *payload)
    if partitions:
        todo = todo.repartition(partitions, key)
    schema = StructType().add(key, items.schema[key].dataType).add("embedding", ArrayType(DoubleType()))
    return todo.mapInArrow(in_small_batches(encoder, schema), schema).withColumn("encoder_uri", F.lit(encoder_uri))


def merge_embeddings(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Stored vectors with the fresh ones replacing any of the same id."""
    return existing.join(fresh.select(key), key, "left_anti").unionByName(
        fresh.select(*existing.columns)
    )


def detect_items(
    images: DataFrame, detector: Model, payload: list[str], min_score: float = 0.40, min_area: float = 0.008
) -> DataFrame:
    """Boxes per image above the score and area floors, with repeatable ids.

    The detector yields ``post_id, label, category, score, x1, y1, x2, y2, area_frac``.
    """
    id_type = images.schema["post_id"].dataType.simpleString()
    schema = (
        f"post_id {id_type}, label int, category string, score double, "
        "x1 double, y1 double, x2 double, y2 double, area_frac double"
    )
    boxes = images.select("post_id", *payload).mapInPandas(detector, schema)
    return boxes.where((F.col("score") >= min_score) & (F.col("area_frac") >= min_area)).select(
        detection_id("post_id", "label", "x1", "y1").alias("detection_id"), *[c for c in boxes.columns if c != "label"]
    )


def keep_boxes(
    boxes: DataFrame, width: float, height: float, min_score: float = 0.40, min_area: float = 0.008
) -> DataFrame:
    """Boxes that a detector delivered (post_id, label, category, score, x1, y1, x2, y2) on images of one size.

    Adds the share of the image that a box covers and a repeatable id; boxes below the floors go, and so do those
    without a score or with corners the wrong way round. Expressions only, so a delivery is filtered as it is read.
    """
    share = box_area_fraction("x1", "y1", "x2", "y2", F.lit(width), F.lit(height))
    kept = boxes.where("x2 > x1 AND y2 > y1").withColumn("area_frac", share)
    return kept.where((F.col("score") >= min_score) & (F.col("area_frac") >= min_area)).select(
        detection_id("post_id", "label", "x1", "y1").alias("detection_id"), "post_id", "category", "score", "x1", "y1", "x2", "y2", "area_frac"
    )


def best_box(detections: DataFrame) -> DataFrame:
    """The box with the largest area times score per image; folded before the shuffle."""
    others = [c for c in detections.columns if c != "post_id"]
    first = F.struct((-F.col("area_frac") * F.col("score")).alias("_p"), "detection_id")
    best = detections.groupBy("post_id").agg(F.min_by(F.struct(*others), first).alias("_box"))
    return best.select("post_id", "_box.*")


def expand_items(images: DataFrame, detections: DataFrame, buckets: int = 256) -> DataFrame:
    """One row per garment, largest and surest first, ``item_index`` from 0.

    An image without boxes becomes one whole-image row: score 0, area 1, no category.
    """
    priority = F.col("area_frac") * F.col("score")
    found = rank_in_groups(
        detections,
        ["post_id"],
        F.floor((1 - priority) * buckets),
        [priority.desc(), F.asc("detection_id")],
        "_place",
    ).select("post_id", (F.col("_place") - 1).alias("item_index"), "category", "score", "area_frac")
    return (
        images.select("post_id")
        .join(found, "post_id", "left")
        .select(
            "post_id",
            F.coalesce("item_index", F.lit(0)).alias("item_index"),
            "category",
            F.coalesce("score", F.lit(0.0)).alias("score"),
            F.coalesce("area_frac", F.lit(1.0)).alias("area_frac"),
            F.col("item_index").isNull().alias("used_whole_image"),
        )
    )


def first_items(images: DataFrame, detections: DataFrame) -> DataFrame:
    """One row per image saying whether it fell back to the whole image; ranks no boxes."""
    found = detections.select("post_id").distinct().withColumn("_found", F.lit(True))
    return images.select("post_id").join(found, "post_id", "left").select(
        "post_id", F.lit(0).alias("item_index"), F.col("_found").isNull().alias("used_whole_image")
    )


def fallback_rate(items: DataFrame) -> DataFrame:
    """Share of images where nothing was detected."""
    images = items.where(F.col("item_index") == 0)
    return images.agg(
        F.count(F.lit(1)).alias("n_images"),
        F.round(F.avg(F.col("used_whole_image").cast("double")), 4).alias("fallback_rate"),
    )


def embedding_contract(embeddings: DataFrame, dim: int, tolerance: float = 1e-2, by: list[str] | None = None) -> DataFrame:
    """Counts of vectors with a wrong dimension or a norm away from 1, over all rows."""
    wrong_dim = F.coalesce(F.size("embedding") != dim, F.lit(True))
    wrong_norm = F.coalesce(F.abs(V.norm("embedding") - 1) >= tolerance, F.lit(True))
    checked = embeddings.select(*(by or []), wrong_dim.alias("_dim"), wrong_norm.alias("_norm"))
    return checked.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count(F.when(F.col("_dim"), 1)).alias("wrong_dimension"),
        F.count(F.when(F.col("_norm"), 1)).alias("wrong_norm"),
        (~F.bool_or(F.col("_dim") | F.col("_norm"))).alias("passed"),
    )

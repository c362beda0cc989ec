"""Incoming (anchor image, positive image, category) pairs into products and posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StructType

# Column-name hints, tried in this order.
ANCHOR_HINTS = ["anchor", "query", "crop", "post", "street", "source", "wild"]
POSITIVE_HINTS = ["positive", "target", "product", "thumb", "item", "shop", "catalog"]
CATEGORY_HINTS = ["category", "class", "label", "cat", "type"]


def _first_match(columns: list[str], hints: list[str]) -> str | None:
    matches = ((h, c) for h in hints for c in columns if h in c.lower())
    return next((c for _, c in matches), None)


def infer_roles(schema: StructType, image_columns: list[str]) -> dict[str, str | None]:
    """Which columns hold the anchor, the positive and the category."""
    if len(image_columns) < 2:
        raise ValueError(f"need two image columns, found {image_columns}")
    anchor = _first_match(image_columns, ANCHOR_HINTS) or image_columns[0]
    rest = [c for c in image_columns if c != anchor]
    others = [f.name for f in schema.fields if f.name not in image_columns]
    return {
        "anchor": anchor,
        "positive": _first_match(rest, POSITIVE_HINTS) or rest[0],
        "category": _first_match(others, CATEGORY_HINTS),
    }


def decode_category(df: DataFrame, column: str | None, names: list[str] | None = None) -> Column:
    """Integer class labels to names, anything else to text, no column to ``unknown``."""
    if column is None:
        return F.lit("unknown")
    if names and isinstance(df.schema[column].dataType, IntegralType):
        return F.element_at(F.array(*[F.lit(n) for n in names]), F.col(column).cast("int") + 1)
    return F.col(column).cast("string")


def ingest_pairs(
    pairs: DataFrame, key: str, anchor: str, positive: str, category: Column, source: str, as_of
) -> tuple[DataFrame, DataFrame]:
    """Products and the posts that link them; pairs with a missing image are skipped.

    Ids come from ``key``, so the same pair keeps its id on any partitioning.
    """
    now = F.lit(as_of).cast("timestamp")
    ids = F.concat(F.lit("p"), F.lpad(F.col(key).cast("string"), 7, "0"))
    # lpad would cut longer keys, so those stay as they are.
    ids = F.when(F.length(F.col(key).cast("string")) > 7, F.concat(F.lit("p"), F.col(key).cast("string"))).otherwise(ids)
    both = pairs.where(F.col(anchor).isNotNull() & F.col(positive).isNotNull()).withColumn("product_id", ids)
    products = both.select(
        "product_id", F.col(positive).alias("image_path"), category.alias("category"),
        F.lit(None).cast("string").alias("brand"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("double").alias("price"), F.lit("KRW").alias("currency"),
        F.lit(True).alias("in_stock"), F.lit("KR").alias("region"), F.lit(source).alias("source"),
        F.lit(True).alias("license_ok"), now.alias("ingested_at"), now.alias("updated_at"),
    )
    posts = both.select(
        F.concat(F.lit("post_"), "product_id").alias("post_id"), F.col(anchor).alias("image_path"),
        F.array("product_id").alias("linked_products"), F.lit(source).alias("source"),
        now.alias("captured_at"), F.lit(True).alias("license_ok"), now.alias("ingested_at"),
    )
    return products, posts


def category_quality(products: DataFrame) -> DataFrame:
    """Products per category; all-digit names would never match a named slice."""
    return products.groupBy("category").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "is_numeric", F.coalesce(F.col("category").rlike("^[0-9]+$"), F.lit(False))
    )

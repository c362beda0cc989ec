"""Runs delivered by an outside job: a JSON manifest plus Parquet per stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MARKER = "marker://"


def write_run(products: DataFrame, queries: DataFrame, manifest: DataFrame, inbox: str, stamp: str) -> None:
    """Deliver a run: ``products_<stamp>``, ``queries_<stamp>`` and ``manifest_<stamp>.json``."""
    products.write.parquet(f"{inbox}/products_{stamp}.parquet")
    queries.write.parquet(f"{inbox}/queries_{stamp}.parquet")
    manifest.coalesce(1).write.json(f"{inbox}/manifest_{stamp}.json")


def manifests(spark: SparkSession, inbox: str) -> DataFrame:
    """All manifests with the stamp taken from the file name."""
    read = spark.read.json(f"{inbox}/manifest_*.json")
    stamp = F.regexp_extract(F.input_file_name(), r"manifest_([^/]+?)\.json", 1)
    return read.withColumn("stamp", stamp)


def latest_run(spark: SparkSession, inbox: str) -> tuple[str, DataFrame, DataFrame]:
    """(stamp, products, queries) of the run whose stamp sorts last."""
    stamp = manifests(spark, inbox).agg(F.max("stamp").alias("stamp")).first()["stamp"]
    if stamp is None:
        raise FileNotFoundError(f"no manifest in {inbox}")
    return stamp, spark.read.parquet(f"{inbox}/products_{stamp}.parquet"), spark.read.parquet(f"{inbox}/queries_{stamp}.parquet")


def check_manifest(
    manifest: DataFrame, expected_dim: int, expected_encoder: str, sample_size: int, by: str = "stamp"
) -> DataFrame:
    """One row per run and check; every check but the device one is fatal."""
    def check(name: str, observed: Column, expected, ok: Column, severity: str) -> Column:
        return F.struct(
            F.lit(name).alias("check"), observed.cast("string").alias("observed"),
            F.lit(str(expected)).alias("expected"), F.coalesce(ok, F.lit(False)).alias("passed"),
            F.lit(severity).alias("severity"),
        )

    least = sample_size * 0.9
    checks = F.array(
        check("embedding_dim", F.col("embedding_dim"), expected_dim, F.col("embedding_dim") == expected_dim, "fatal"),
        check("encoder_repo", F.col("encoder_repo"), expected_encoder, F.col("encoder_repo") == expected_encoder, "fatal"),
        check("n_products", F.col("n_products"), sample_size, F.col("n_products") >= least, "fatal"),
        check("device", F.col("device"), "cuda", F.col("device") == "cuda", "note"),
    )
    return manifest.select(by, F.inline(checks))


def measure_run(products: DataFrame, by: list[str]) -> DataFrame:
    """What a run really contains: row count and the smallest and largest dimension."""
    return products.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_products"),
        F.min(F.size("embedding")).alias("embedding_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
    )


def resolve_image_path(items: DataFrame, available: DataFrame, run: str, key: str = "product_id", prefix: str = "") -> DataFrame:
    """``image_path`` of a shipped image, or a marker naming the run and the id.

    ``available`` is ``(key, path)`` of the shipped sample.
    """
    marker = F.concat(F.lit(f"{MARKER}{run}/{prefix}"), F.col(key).cast("string"))
    shipped = available.select(key, F.col("path").alias("_path"))
    return items.join(shipped, key, "left").withColumn("image_path", F.coalesce("_path", marker)).drop("_path")


def viewable(df: DataFrame, path: str = "image_path") -> DataFrame:
    """Rows whose image really exists."""
    return df.where(~F.col(path).startswith(MARKER))


def rebuild_catalogue(products: DataFrame, source: str, as_of) -> DataFrame:
    """Catalogue rows of a run, with defaults for what a run does not know."""
    now = F.lit(as_of).cast("timestamp")
    return products.select(
        "product_id", "image_path", "category",
        F.lit(None).cast("string").alias("brand"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("double").alias("price"), F.lit("KRW").alias("currency"),
        F.lit(True).alias("in_stock"), F.lit("KR").alias("region"), F.lit(source).alias("source"),
        F.lit(True).alias("license_ok"), now.alias("ingested_at"), now.alias("updated_at"),
    )


def rebuild_eval_queries(queries: DataFrame, as_of) -> DataFrame:
    """Evaluation queries of a run: each query's own product is its one relevant id."""
    return queries.select(
        "post_id", F.col("image_path").alias("query_image"), "category",
        F.array("product_id").alias("relevant_ids"),
        F.map_from_arrays(F.array("product_id"), F.array(F.lit(1.0))).alias("relevance_map"),
        F.lit("styled_post").alias("query_condition"), "size_band", "occlusion",
        F.lit(as_of).cast("timestamp").alias("frozen_at"),
    )

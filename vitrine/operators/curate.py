"""Training-pair curation, evaluation sets and click feedback.

Posts arrive in long form ``(post_id, product_id)``; ``posts_long`` makes it from
the array form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import hash_bucket, occlusion, size_band
from .blocks import block_duplicates
from .monitor import since
from .retrieve import bucket_parts, exact_topk, with_buckets, with_parts
from .skew import nest_in_chunks


def posts_long(posts: DataFrame) -> DataFrame:
    """One row per (post, linked product)."""
    return posts.select("post_id", F.explode("linked_products").alias("product_id"))


def licensed(df: DataFrame) -> DataFrame:
    return df.where(F.col("license_ok"))


def keep_detections(detections: DataFrame, min_score: float = 0.40, min_area: float = 0.008) -> DataFrame:
    return detections.where((F.col("score") >= min_score) & (F.col("area_frac") >= min_area))


def with_slice_labels(df: DataFrame, area: str = "area_frac") -> DataFrame:
    return df.withColumn("size_band", size_band(area)).withColumn("occlusion", occlusion(area))


def _group_sizes(df: DataFrame, carry: list[str]) -> DataFrame:
    return df.groupBy("post_id", "category").agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in carry]
    )


def _sides(detections: DataFrame, post_products: DataFrame, products: DataFrame, min_score: float):
    boxes = _group_sizes(
        detections.where(F.col("score") >= min_score).withColumnRenamed("detection_id", "pair_id"),
        [c for c in ("pair_id", "crop_path", "score", "area_frac") if c in detections.columns or c == "pair_id"],
    )
    links = post_products.join(
        licensed(products).select("product_id", F.col("image_path").alias("positive_path"), "category"), "product_id"
    )
    return boxes, _group_sizes(links, ["product_id", "positive_path"])


def build_pairs(
    detections: DataFrame, post_products: DataFrame, products: DataFrame, min_score: float = 0.45
) -> DataFrame:
    """Unambiguous (detection, product) pairs of equal category within a post.

    A (post, category) group counts boxes times linked products after the joins,
    so it holds exactly one pair only when it has one box and one product. Both
    sides are therefore folded to their single-row groups first: a crowded post
    costs one counter instead of the product of its sides, and the final join is
    one-to-one on keys both sides are already partitioned by.
    """
    boxes, links = _sides(detections, post_products, products, min_score)
    one = F.col("_n") == 1
    pairs = boxes.where(one).drop("_n").join(links.where(one).drop("_n"), ["post_id", "category"])
    if "crop_path" in pairs.columns:
        pairs = pairs.withColumnRenamed("crop_path", "anchor_path")
    order = ["pair_id", "product_id", "post_id", "anchor_path", "positive_path", "category", "score", "area_frac"]
    return pairs.select(*[c for c in order if c in pairs.columns])


def ambiguous_groups(
    detections: DataFrame, post_products: DataFrame, products: DataFrame, min_score: float = 0.45
) -> DataFrame:
    """(post, category) groups that would yield more than one pair, with that count."""
    boxes, links = _sides(detections, post_products, products, min_score)
    return (
        boxes.select("post_id", "category", F.col("_n").alias("_d"))
        .join(links.select("post_id", "category", F.col("_n").alias("_p")), ["post_id", "category"])
        .select("post_id", "category", (F.col("_d") * F.col("_p")).alias("n_pairs"))
        .where(F.col("n_pairs") > 1)
    )


def with_clicks(pairs: DataFrame, clicks: DataFrame) -> DataFrame:
    """Append click pairs; they bypass the ambiguity filter."""
    return pairs.unionByName(clicks.select(*pairs.columns))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.97, **blocks) -> DataFrame:
    """``drop_id`` of products with a lower-id near copy in their category."""
    return block_duplicates(embeddings, threshold, ["category"], **blocks)


def near_duplicates_hashed(
    embeddings: DataFrame, dim: int, threshold: float = 0.97, bits: int = 12, tables: int = 24, **blocks
) -> DataFrame:
    """``near_duplicates`` among products that share a hash bucket in some table.

    For catalogues too large to compare within a category. Every id reported is
    right. A pair at angle a shares a given bucket with probability
    ``(1 - a/pi) ** bits``; at cosine 0.97 with the defaults one pair in about
    80 000 is missed, and closer pairs far more rarely. The work grows with the
    catalogue times the size of a bucket.
    """
    parts = bucket_parts(embeddings, bits)
    bucketed = with_parts(with_buckets(embeddings, "product_id", dim, bits, tables), parts)
    return block_duplicates(bucketed, threshold, ["category", "lsh_table", "lsh_part"], within="lsh_bucket", **blocks)


def drop_products(pairs: DataFrame, drops: DataFrame) -> DataFrame:
    return pairs.join(drops.select(F.col("drop_id").alias("product_id")), "product_id", "left_anti")


def split_by_key(df: DataFrame, key: str = "product_id", fraction: float = 0.08, mode: str = "murmur") -> DataFrame:
    """Deterministic train/eval split by key, so a product is always on one side."""
    return split_by_cut(df, key, int(fraction * 1000), mode)


def split_by_cut(df: DataFrame, key: str, cut: int, mode: str = "murmur") -> DataFrame:
    return df.withColumn("split", F.when(hash_bucket(key, 1000, mode) < cut, "eval").otherwise("train"))


def eval_cut(eval_queries: int, n_products: int) -> int:
    """Bucket cut that aims at ``eval_queries``, but at least 50 of 1000."""
    return max(int(eval_queries / max(n_products, 1) * 1000), 50)


def leakage(train: DataFrame, evaluation: DataFrame, key: str = "product_id") -> DataFrame:
    """One row: how many keys appear on both sides."""
    shared = train.select(key).intersect(evaluation.select(key))
    return shared.agg(F.count(F.lit(1)).alias("n_overlap"))


def assert_no_leakage(train: DataFrame, evaluation: DataFrame, key: str = "product_id") -> None:
    n = leakage(train, evaluation, key).first()["n_overlap"]
    if n:
        raise ValueError(f"{n} values of {key} are on both sides of the split")


def prepare_eval_set(post_products: DataFrame, products: DataFrame, cut: int, mode: str = "murmur") -> DataFrame:
    """Held-out judgments in long form: post, category, product, grade, slice defaults.

    ``post_products`` may carry ``query_image``.
    """
    image = ["query_image"] if "query_image" in post_products.columns else []
    linked = post_products.join(products.select("product_id", "category"), "product_id")
    held_out = split_by_cut(linked, "product_id", cut, mode).where(F.col("split") == "eval")
    return held_out.select("post_id", *image, "category", "product_id").distinct().select(
        "*",
        F.lit(1.0).alias("grade"),
        F.lit("styled_post").alias("query_condition"),
        F.lit("unknown").alias("size_band"),
        F.lit("unknown").alias("occlusion"),
    )


def nest_judgments(judgments: DataFrame, keys: list[str], chunk_rows: int = 1024) -> DataFrame:
    """Array and map form of judgments graded 1.0, in bounded chunks per query."""
    nested = nest_in_chunks(judgments, keys, "product_id", "relevant_ids", chunk_rows)
    return nested.withColumn(
        "relevance_map",
        F.map_from_arrays("relevant_ids", F.transform("relevant_ids", lambda _: F.lit(1.0))),
    )


def slice_coverage(eval_queries: DataFrame, protected: list[tuple[str, str]], min_queries: int = 20) -> DataFrame:
    """Queries per protected slice and the eval-set size that would reach the floor."""
    dims = sorted({d for d, _ in protected if d in eval_queries.columns})
    tags = F.array(*[F.struct(F.lit(d).alias("slice_dim"), F.col(d).cast("string").alias("slice_value")) for d in dims])
    counts = eval_queries.select(F.inline(tags)).groupBy("slice_dim", "slice_value").agg(F.count(F.lit(1)).alias("_n"))
    total = eval_queries.agg(F.count(F.lit(1)).alias("t")).scalar()
    wanted = eval_queries.sparkSession.createDataFrame(
        [(d, v) for d, v in protected if d in dims], "slice_dim string, slice_value string"
    )
    n = F.coalesce(F.col("_n"), F.lit(0))
    return (
        wanted.join(counts, ["slice_dim", "slice_value"], "left")
        .select("slice_dim", "slice_value", n.alias("n_queries"), total.alias("_total"))
        .withColumn("share", F.when(F.col("_total") > 0, F.col("n_queries") / F.col("_total")).otherwise(0.0))
        .withColumn("status", F.when(F.col("n_queries") >= min_queries, "OK").otherwise("TOO FEW"))
        .withColumn(
            "needed",
            F.when(
                (F.col("n_queries") < min_queries) & (F.col("share") > 0),
                F.floor(F.lit(min_queries) / F.col("share") * 1.15),
            ).cast("bigint"),
        )
        .drop("_total")
    )


def fold_slice_labels(eval_queries: DataFrame, labels: DataFrame, key: str = "post_id") -> DataFrame:
    """Matched queries take the measured size band and occlusion; others keep theirs."""
    new = labels.select(key, F.col("size_band").alias("_size"), F.col("occlusion").alias("_occ"))
    return (
        eval_queries.join(new, key, "left")
        .withColumn("size_band", F.coalesce("_size", "size_band"))
        .withColumn("occlusion", F.coalesce("_occ", "occlusion"))
        .drop("_size", "_occ")
    )


def _recent_with_image(events: DataFrame, as_of, days: int) -> DataFrame:
    return since(events, as_of, days).where(F.col("query_image").isNotNull())


def click_pairs(
    events: DataFrame, products: DataFrame, as_of, days: int = 30, max_pairs: int | None = None
) -> DataFrame:
    """Clicked results as positive pairs: all of them, or the newest ``max_pairs`` where a caller asks for a top list."""
    clicked = _recent_with_image(events, as_of, days).select(
        "event_id", "event_ts", "query_image", F.col("selected_category").alias("category"),
        F.explode("clicked").alias("product_id"),
    )
    pairs = clicked.join(products.select("product_id", F.col("image_path").alias("positive_path")), "product_id")
    if max_pairs is not None:
        pairs = pairs.orderBy(F.desc("event_ts"), "event_id", "product_id").limit(max_pairs)
    return pairs.select(
        F.concat(F.lit("click_"), F.col("event_id").cast("string"), F.lit("_"), F.col("product_id").cast("string")).alias("pair_id"),
        "product_id",
        F.col("event_id").alias("post_id"),
        F.col("query_image").alias("anchor_path"),
        "positive_path",
        "category",
        F.lit(1.0).alias("score"),
        F.lit(0.0).alias("area_frac"),
    )


def hard_negatives(events: DataFrame, as_of, days: int = 30, top: int = 5) -> DataFrame:
    """Results shown near the top of a clicked search and not clicked themselves."""
    shown = _recent_with_image(events, as_of, days).where(F.size("clicked") > 0).select(
        "event_id",
        F.col("query_image").alias("anchor_path"),
        "clicked",
        F.posexplode(F.slice("results_shown", 1, top)).alias("shown_rank", "negative_product_id"),
    )
    return shown.where(~F.array_contains("clicked", F.col("negative_product_id"))).drop("clicked")


def mine_hard_negatives(
    anchors: DataFrame, catalogue: DataFrame, positives: DataFrame, k: int = 50, **blocks
) -> DataFrame:
    """What the current vectors rank in the top ``k`` although it is not a positive."""
    return exact_topk(anchors, catalogue, k, **blocks).join(
        positives.select("query_id", "product_id"), ["query_id", "product_id"], "left_anti"
    )


def pair_stats(pairs: DataFrame, by: list[str]) -> DataFrame:
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, category: str | None = None) -> DataFrame:
    """A repeatable sample of ``n`` rows: the lowest seeded hashes, on any partitioning."""
    if category is not None:
        df = df.where(F.col("category") == category)
    draw = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")

"""Vector retrieval with metadata filters.

Queries carry ``query_id, category, embedding``; the catalogue carries
``product_id, category, embedding`` and, where used, ``in_stock, region,
business_score``. Rankings are ``(query_id, rank, product_id, score)``; a query
whose category has no products simply has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StructType

from ..functions import vectors as V
from .blocks import CATALOGUE_BLOCK, SCORE_DIGITS, block_topk, merge_topk
from .skew import fetch_if_small


def latest_vectors(embeddings: DataFrame, version: str = "embedded_at", id_column: str = "product_id") -> DataFrame:
    """One row per id, the newest; copies are folded before the shuffle."""
    others = [c for c in embeddings.columns if c != id_column]
    newest = embeddings.groupBy(id_column).agg(F.max_by(F.struct(*others), F.col(version)).alias("_row"))
    return newest.select(id_column, "_row.*")


def catalogue_vectors(embeddings: DataFrame, products: DataFrame) -> DataFrame:
    """Embeddings joined to the product attributes they are filtered by."""
    return products.join(embeddings, "product_id")


def metadata_filter(
    catalogue: DataFrame, in_stock_only: bool = True, region: str | None = None
) -> DataFrame:
    """Hard filters applied before scoring; they are never relaxed."""
    if in_stock_only:
        catalogue = catalogue.where(F.col("in_stock"))
    if region is not None:
        catalogue = catalogue.where(F.col("region") == region)
    return catalogue


def exact_topk(
    queries: DataFrame, catalogue: DataFrame, k: int, by: list[str] | None = None, **blocks
) -> DataFrame:
    """The ``k`` most similar products of each query's own category, by cosine."""
    return merge_topk(block_topk(queries, catalogue, k, by or ["category"], **blocks), k)


def truncated_topk(queries: DataFrame, catalogue: DataFrame, k: int, dim: int, **blocks) -> DataFrame:
    """``exact_topk`` over the first ``dim`` components, renormalised."""
    cut = V.truncate("embedding", dim)
    return exact_topk(
        queries.withColumn("embedding", cut), catalogue.withColumn("embedding", cut), k, **blocks
    )


def _rerank(candidates: DataFrame, queries: DataFrame, catalogue: DataFrame, k: int, weight: float) -> DataFrame:
    """Rescore (query, product) candidates with the full vectors and a business score."""
    business = (
        F.coalesce(F.col("business_score"), F.lit(0.0)) if "business_score" in catalogue.columns else F.lit(0.0)
    )
    products = catalogue.select("product_id", V.unit("embedding").alias("_p"), business.alias("_business"))
    asked = queries.select("query_id", V.unit("embedding").alias("_q"))
    scored = (
        candidates.select("query_id", "product_id")
        .join(products, "product_id")
        .join(asked, "query_id")
        .select("query_id", "product_id", V.dot("_q", "_p").alias("vector_score"), "_business")
        .select(
            "query_id", "product_id", "vector_score",
            F.round((1 - weight) * F.col("vector_score") + weight * F.col("_business"), SCORE_DIGITS).alias("score"),
        )
    )
    return merge_topk(scored, k, ["vector_score"])


def _best_of_recalled(partial: DataFrame, recall_k: int, final_k: int, weight: float) -> DataFrame:
    """The best ``final_k`` by full score among each query's ``recall_k`` recalled products.

    Both rankings share one shuffle by query, and both limits are applied to a task's rows before it.
    """
    business = F.coalesce(F.col("business_score"), F.lit(0.0)) if "business_score" in partial.columns else F.lit(0.0)
    recalled = merge_topk(partial, recall_k, [c for c in ("full_score", "business_score") if c in partial.columns])
    scored = recalled.select(
        "query_id", "product_id", F.col("full_score").alias("vector_score"),
        F.round((1 - weight) * F.col("full_score") + weight * business, SCORE_DIGITS).alias("score"),
    )
    return merge_topk(scored, final_k, ["vector_score"])


def two_stage_search(
    queries: DataFrame,
    catalogue: DataFrame,
    recall_k: int = 500,
    recall_dim: int = 64,
    final_k: int = 20,
    business_weight: float = 0.15,
    in_stock_only: bool = True,
    region: str | None = None,
    **blocks,
) -> DataFrame:
    """Wide recall on truncated vectors, then a precise rerank of the survivors.

    A block scores its survivors with the whole vectors while it has them, so the rerank joins nothing.
    """
    allowed = metadata_filter(catalogue, in_stock_only, region)
    carry = ["business_score"] if "business_score" in catalogue.columns else []
    partial = block_topk(queries, allowed, recall_k, ["category"], view=("prefix", recall_dim), carry=carry, **blocks)
    return _best_of_recalled(partial, recall_k, final_k, business_weight)


def restrict_or_open(items: DataFrame, catalogue: DataFrame, open_key: str = "*") -> tuple[DataFrame, DataFrame]:
    """Give items of a category the catalogue knows their own scope, all others an open one.

    The open scope holds every product. Both scopes stay equi-join keys; the
    catalogue is doubled only when open items exist to be matched by the block
    join, which drops keys that one side lacks.
    """
    known = catalogue.select("category").distinct().withColumn("_known", F.lit(True))
    own = F.concat(F.lit("="), F.col("category"))  # no category is spelled like the open scope
    scoped_items = items.join(known, "category", "left").withColumn("scope", F.when(F.col("_known"), own).otherwise(open_key)).drop("_known")
    scoped_catalogue = catalogue.withColumn("scope", F.explode(F.array(own, F.lit(open_key))))
    return scoped_items, scoped_catalogue


def multi_item_search(items: DataFrame, catalogue: DataFrame, k: int = 12, **blocks) -> DataFrame:
    """One ranking per detected garment of an image.

    ``items`` carries ``image_id, item_index, category, embedding``. A garment of
    an unknown or missing category searches everything. A null image or item index
    is a key like any other.
    """
    key = F.struct("image_id", "item_index")  # nulls in it stay what they are
    scoped, products = restrict_or_open(items.withColumn("query_id", key), catalogue)
    ranked = exact_topk(scoped, products, k, by=["scope"], **blocks)
    return ranked.select("query_id.image_id", F.col("query_id.item_index").cast("int").alias("item_index"), "rank", "product_id", "score")


def int8_topk(queries: DataFrame, catalogue: DataFrame, k: int, **blocks) -> DataFrame:
    """Top-k over vectors quantised to signed bytes; the score is the integer product / 127²."""
    q = queries.withColumn("embedding", V.int8("embedding").cast("array<tinyint>"))
    c = catalogue.withColumn("embedding", V.int8("embedding").cast("array<tinyint>"))
    ranked = merge_topk(block_topk(q, c, k, ["category"], metric="dot", **blocks), k)
    return ranked.withColumn("score", F.col("score") / (127 * 127))


def binary_rerank(
    queries: DataFrame, catalogue: DataFrame, dim: int, recall_k: int = 500, final_k: int = 20, **blocks
) -> DataFrame:
    """Recall by Hamming distance of sign bits, rerank with the full vectors inside the same block."""
    partial = block_topk(queries, catalogue, recall_k, ["category"], metric="hamming", view=("signs", dim), **blocks)
    return _best_of_recalled(partial, recall_k, final_k, 0.0).drop("vector_score")


def _pieces(batches, rows: int = 1_000):
    """Batches of at most ``rows`` rows, so that what is made of one at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _hasher(dim: int, bits: int, tables: int, probes: int, seed: int):
    """A function from a column of vectors to their buckets: (row, table, probe), the own one first."""
    planes = np.random.RandomState(seed).standard_normal((dim, tables * bits))

    def buckets_of(vectors: pa.Array) -> np.ndarray:
        weights = 1 << np.arange(bits, dtype=np.int64)
        m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        margin = (m @ planes).reshape(len(m), tables, bits)
        own = ((margin > 0) * weights).sum(axis=2)
        flips = np.argsort(np.abs(margin), axis=2, kind="stable")[:, :, : probes - 1]
        return np.concatenate([own[:, :, None], own[:, :, None] ^ weights[flips]], axis=2)

    return buckets_of


def with_codes(df: DataFrame, id_column: str, dim: int, bits: int, tables: int, probes: int = 1, seed: int = 7) -> DataFrame:
    """The buckets of ``with_buckets`` as one array ``lsh_codes`` per row, table after table; for up to 15 bits."""
    columns = [id_column, "category", "embedding"]
    base = df.where(F.col("embedding").isNotNull()).select(*columns)
    schema = StructType([*base.schema.fields]).add("lsh_codes", ArrayType(ShortType()))
    buckets_of = _hasher(dim, bits, tables, probes, seed)

    def assign(batches):
        for batch in _pieces(batches):
            codes = buckets_of(batch.column("embedding")).astype(np.int16).reshape(batch.num_rows, -1)
            offsets = np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))],
                names=[*columns, "lsh_codes"],
            )

    return base.mapInArrow(assign, schema)


def with_buckets(
    df: DataFrame, id_column: str, dim: int, bits: int, tables: int, probes: int = 1, seed: int = 7
) -> DataFrame:
    """One row per (id, table, probed bucket) of a random-hyperplane hash.

    A bucket collects the sign bits of ``bits`` projections. Further probes flip
    the bits with the smallest margins, one at a time.
    """
    columns = [id_column, "category", "embedding"]
    base = df.where(F.col("embedding").isNotNull()).select(*columns)
    schema = StructType([*base.schema.fields]).add("lsh_table", IntegerType()).add("lsh_bucket", LongType())
    buckets_of = _hasher(dim, bits, tables, probes, seed)

    def assign(batches):
        for batch in _pieces(batches):
            buckets = buckets_of(batch.column("embedding"))
            n_probes = buckets.shape[2]
            take = pa.array(np.repeat(np.arange(len(buckets)), tables * n_probes))
            table = np.tile(np.repeat(np.arange(tables, dtype=np.int32), n_probes), len(buckets))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in columns), pa.array(table), pa.array(buckets.ravel())],
                names=[*columns, "lsh_table", "lsh_bucket"],
            )

    return base.mapInArrow(assign, schema)


def bucket_parts(vectors: DataFrame, bits: int) -> DataFrame:
    """(category, parts): into how many parts of about one block a hash table is cut."""
    rows = F.count(F.lit(1))
    parts = F.least(F.ceil(rows / CATALOGUE_BLOCK), F.lit(2**bits)).cast("bigint")
    return fetch_if_small(vectors.groupBy("category").agg(parts.alias("_parts")))


def with_parts(bucketed: DataFrame, parts: DataFrame) -> DataFrame:
    """Spread the buckets of a (category, table) over its parts; a bucket stays whole."""
    return bucketed.join(parts, "category").withColumn("lsh_part", F.col("lsh_bucket") % F.col("_parts")).drop("_parts")


def ann_topk(
    queries: DataFrame,
    catalogue: DataFrame,
    k: int,
    dim: int,
    bits: int = 8,
    tables: int = 8,
    probes: int = 6,
    seed: int = 7,
    in_stock_only: bool = False,
    region: str | None = None,
    **blocks,
) -> DataFrame:
    """Approximate top-k: candidates share a hash bucket, their scores are exact.

    A bucket is one more equi-key of the blocked join, so crowded buckets are cut
    into blocks like any other hot key. About ``tables * probes / 2**bits`` of a
    category is scored per query: add bits as the catalogue grows, and tables or
    probes for recall (``recall_against`` measures it). Where that is more than the
    whole category, a vector is sent once with all its buckets instead of once per
    table and probe, and the block compares them.
    """
    allowed = metadata_filter(catalogue, in_stock_only, region)
    if tables * probes >= 2**bits and bits <= 15 and allowed.groupBy("product_id").count().where("count > 1").isEmpty():
        c = with_codes(allowed, "product_id", dim, bits, tables, 1, seed)
        q = with_codes(queries, "query_id", dim, bits, tables, probes, seed)
        found = block_topk(q, c, k, ["category"], shared="lsh_codes", **blocks)
        return merge_topk(found.groupBy("query_id", "product_id").agg(F.max("score").alias("score")), k)
    parts = bucket_parts(allowed, bits)
    c = with_parts(with_buckets(allowed, "product_id", dim, bits, tables, 1, seed), parts)
    q = with_parts(with_buckets(queries, "query_id", dim, bits, tables, probes, seed), parts)
    found = block_topk(q, c, k, ["category", "lsh_table", "lsh_part"], within="lsh_bucket", **blocks)
    return merge_topk(found.groupBy("query_id", "product_id").agg(F.max("score").alias("score")), k)


def recall_against(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of the exact ranking that the approximate ranking also returned."""
    hit = approximate.select("query_id", "product_id", F.lit(1).alias("_hit"))
    return exact.join(hit, ["query_id", "product_id"], "left").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("_hit").alias("n_found"),
        (F.count("_hit") / F.count(F.lit(1))).alias("recall"),
    )


def hit_report(results: DataFrame, relevance: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Queries searched, queries with a correct answer, hit rate and median first rank."""
    by = by or []
    asked = relevance.select("query_id", *by).distinct()
    first = (
        results.join(relevance.select("query_id", "product_id").distinct(), ["query_id", "product_id"])
        .groupBy("query_id")
        .agg(F.min("rank").alias("first_rank"))
    )
    joined = asked.join(first, "query_id", "left")
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.count("first_rank").alias("n_hits"),
        (F.count("first_rank") / F.count(F.lit(1))).alias("hit_rate"),
        F.percentile("first_rank", F.lit(0.5)).cast("int").alias("median_rank"),
    )

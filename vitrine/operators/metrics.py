"""Ranking metrics per query and per slice.

``results`` is ``(query_id, rank, product_id)``, ``relevance`` is
``(query_id, product_id, grade)``. A metric that cannot be measured (nothing
relevant, or an ideal gain of zero) is NULL and leaves the averages alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

K_VALUES = (1, 5, 10, 20, 50)
SLICE_DIMENSIONS = ("category", "query_condition", "size_band", "occlusion")


def metric_names(k_values=K_VALUES) -> list[str]:
    return [f"recall_at_{k}" for k in k_values] + [f"ndcg_at_{k}" for k in k_values] + ["mrr"]


def _gain(place: str, k: int) -> str:
    return f"sum(CASE WHEN {place} <= {k} THEN grade / log2({place} + 1) END)"


def query_metrics(
    queries: DataFrame, results: DataFrame, relevance: DataFrame, k_values=K_VALUES
) -> DataFrame:
    """Recall@k, NDCG@k and reciprocal rank for every row of ``queries`` (``query_id``).

    Judgments are folded per query before they meet: counts for recall, and the
    ``max(k)`` best grades (a per-task limit below the shuffle) for the ideal gain.
    """
    k_max = max(k_values)
    judged = relevance.groupBy("query_id", "product_id").agg(F.max("grade").alias("grade"))
    hits = (
        results.select("query_id", "rank", "product_id")
        .join(judged, ["query_id", "product_id"])
        .groupBy("query_id")
        .agg(
            F.min("rank").alias("_first"),
            *[F.expr(f"count(CASE WHEN rank <= {k} THEN 1 END) AS _hits_{k}") for k in k_values],
            *[F.expr(f"{_gain('rank', k)} AS _dcg_{k}") for k in k_values],
        )
    )
    relevant = judged.groupBy("query_id").agg(F.count(F.lit(1)).alias("_relevant"))
    by_grade = Window.partitionBy("query_id").orderBy(F.desc("grade"))
    ideal = (
        judged.withColumn("_place", F.row_number().over(by_grade))
        .where(F.col("_place") <= k_max)
        .groupBy("query_id")
        .agg(*[F.expr(f"{_gain('_place', k)} AS _idcg_{k}") for k in k_values])
    )
    wide = queries.join(hits, "query_id", "left").join(relevant, "query_id", "left").join(ideal, "query_id", "left")
    return wide.selectExpr(
        *[f"`{c}`" for c in queries.columns],
        *[f"coalesce(_hits_{k}, 0) / _relevant AS recall_at_{k}" for k in k_values],
        *[f"CASE WHEN _idcg_{k} > 0 THEN coalesce(_dcg_{k}, 0) / _idcg_{k} END AS ndcg_at_{k}" for k in k_values],
        "coalesce(1D / _first, 0D) AS mrr",
    )


def slice_metrics(per_query: DataFrame, dims=SLICE_DIMENSIONS, k_values=K_VALUES) -> DataFrame:
    """Mean metrics per (slice_dim, slice_value), plus the row overall/all.

    One pass: every query is emitted once per slice it belongs to and folded
    before the shuffle. A NULL slice value belongs to no slice of that dimension.
    """
    slices = [F.struct(F.lit("overall").alias("slice_dim"), F.lit("all").alias("slice_value"))]
    slices += [
        F.struct(F.lit(d).alias("slice_dim"), F.col(d).cast("string").alias("slice_value")) for d in dims
    ]
    names = metric_names(k_values)
    return (
        per_query.select(F.inline(F.array(*slices)), *names)
        .where(F.col("slice_value").isNotNull())
        .groupBy("slice_dim", "slice_value")
        .agg(F.count(F.lit(1)).alias("n_queries"), *[F.expr(f"avg({m}) AS {m}") for m in names])
    )

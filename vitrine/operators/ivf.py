"""Approximate search over a stored inverted-file index.

A category's vectors are dealt to lists, each around a centroid found by k-means. The index keeps a row per product in
its list's folder: a short code of the difference to the centroid, and the whole vector. A search looks up a query's
nearest centroids, scores only the codes of those lists, and scores the best of them again with the whole vectors.

Vectors become integers first (components of the unit vector times 1024, rounded down), and centroids are integer
means, so training, assignment and codes are exact whatever the order of summation: every run, and any other engine,
builds the same index.

Ids are unique per category. Rows without a vector or of length zero are not indexed; a category without products
answers nothing. All vectors of a category have one dimension.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import vectors as V
from ..functions.scalars import hash_bucket
from .blocks import (
    _TILE_CELLS, CATALOGUE_BLOCK, QUERY_BLOCK, SCORE_DIGITS, _arrow_schema, _best_per_row, _block_of, _blocks, _cosines, _every, _matrix,
    block_topk, merge_topk,
)
from .skew import fetch_if_small

SCALE = 1024
STEP = 16
_SLOTS = 65_536


def integer_unit(vector: str = "embedding") -> Column:
    return F.transform(V.unit(vector), lambda x: F.floor(x * SCALE).cast("int"))


def _long_sum(products: Column) -> Column:
    return F.aggregate(products, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _seeker(q: str) -> Column:
    """[2q, -1]: its product with ``_target`` is larger for a nearer centroid."""
    return F.concat(F.transform(q, lambda x: (2 * x).cast("long")), F.array(F.lit(-1).cast("long")))


def _target(c: str) -> Column:
    square = _long_sum(F.transform(c, lambda x: x.cast("long") * x.cast("long")))
    return F.concat(F.transform(c, lambda x: x.cast("long")), F.array(square))


def nearest_lists(rows: DataFrame, centroids: DataFrame, n: int, id_column: str) -> DataFrame:
    """(``id_column``, list, place): the ``n`` nearest lists of the row's category; the smaller list wins a tie.

    ``rows`` has category and q, ``centroids`` has category, list and centroid. Both sides are cut into blocks, so
    neither a hot category nor many lists meet in one task.
    """
    found = block_topk(
        rows.select(F.col(id_column).alias("query_id"), "category", _seeker("q").alias("embedding")),
        centroids.select(F.col("list").alias("product_id"), "category", _target("centroid").alias("embedding")),
        n, ["category"], metric="dot",
    )
    ranked = merge_topk(found, n)
    return ranked.select(F.col("query_id").alias(id_column), F.col("product_id").alias("list"), F.col("rank").alias("place"))


def train(rows: DataFrame, dim: int, rows_per_list: int, rounds: int = 2, sample: float = 1.0) -> DataFrame:
    """(category, list, centroid): integer k-means per category, from about one seed per ``rows_per_list`` rows.

    ``rows`` has product_id, category and q. Seeds are chosen by a hash of the id, and the smallest id of a category,
    so that each has one. ``sample`` is the share of the rows, also by hash, that move the centroids; all of them are
    indexed afterwards. A list that loses its last row goes.
    """
    slot = hash_bucket("product_id", _SLOTS, "md5")
    least = rows.groupBy("category").agg(F.min("product_id").alias("_least"))
    seeds = rows.withColumn("_slot", slot).join(least, "category").where(
        (F.col("_slot") < max(1, _SLOTS // rows_per_list)) | (F.col("product_id") == F.col("_least"))
    )
    centroids = seeds.select("category", F.col("product_id").alias("list"), F.col("q").alias("centroid"))
    taught = rows if sample >= 1 else rows.where(F.pmod(slot * 31, F.lit(_SLOTS)) < int(sample * _SLOTS))
    for _ in range(rounds):
        dealt = nearest_lists(taught, centroids, 1, "product_id").drop("place")
        # One sum per component: folded before the shuffle, and rows are not multiplied by the dimension.
        sums = taught.join(dealt, "product_id").groupBy("category", "list").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.element_at("q", d + 1).cast("long")).alias(f"s{d}") for d in range(dim)]
        )
        mean = F.array(*[F.floor(F.col(f"s{d}") / F.col("n")).cast("int") for d in range(dim)])
        centroids = sums.select("category", "list", mean.alias("centroid"))
    return centroids


def build(
    catalogue: DataFrame, path: str, dim: int, rows_per_list: int = 10_000, rounds: int = 2, sample: float = 1.0
) -> DataFrame:
    """Train, deal all products and write the index below ``path``; returns its centroids.

    ``path/centroids`` has (category, list, centroid); ``path/lists`` has a row per product in folders by category and
    list: product_id, code, embedding and the catalogue's other columns. Codes are signed bytes.
    """
    spark = catalogue.sparkSession
    rows = catalogue.withColumn("q", integer_unit()).where("q IS NOT NULL")
    # The id, category and integers are read once per round.
    rows.select("product_id", "category", "q").write.parquet(f"{path}/integers")
    slim = spark.read.parquet(f"{path}/integers")
    train(slim, dim, rows_per_list, rounds, sample).write.parquet(f"{path}/centroids")
    centroids = spark.read.parquet(f"{path}/centroids")
    dealt = nearest_lists(slim, centroids, 1, "product_id").drop("place")
    code = F.zip_with("q", "centroid", lambda x, c: F.greatest(F.lit(-128), F.least(F.lit(127), F.floor((x - c) / STEP))).cast("tinyint"))
    listed = rows.join(dealt, "product_id").join(centroids.select("list", "centroid"), "list").withColumn("code", code)
    # Rebalancing brings a list's rows together and still splits a crowded list.
    listed.drop("q", "centroid").hint("rebalance", "category", "list").write.partitionBy("category", "list").parquet(f"{path}/lists")
    return centroids


def lists_of(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/lists")


def _near_and_far(asked: np.ndarray, centroids: np.ndarray):
    """(first row, scores) of some rows of ``asked`` at a time: larger for a nearer centroid. Integers, so doubles hold them exactly."""
    squares = np.einsum("ij,ij->i", centroids, centroids)
    step = max(1, _TILE_CELLS // max(1, len(centroids)))
    for start in range(0, len(asked) if len(centroids) else 0, step):
        yield start, 2 * (asked[start : start + step] @ centroids.T) - squares


def last_probed(asked: DataFrame, centroids: DataFrame, share: float) -> DataFrame:
    """(query_id, category, cut, cut_list): score and number of the last list that a query asks, which is one row per query for any number of lists.

    Of a category's lists the nearest ``share`` is asked, the smaller list first in a tie. A block of queries meets all centroids of its
    category, about two bytes per component and list.
    """
    sizes = fetch_if_small(asked.groupBy("category").agg(_blocks(F.count(F.lit(1)), QUERY_BLOCK).alias("_nq")))
    small = "array<smallint>"
    q = asked.join(sizes, "category").select(F.col("query_id").alias("_q"), F.col("category").alias("_qc"), _block_of("query_id", "_nq").alias("_qb"), F.col("q").cast(small).alias("_v"))
    c = centroids.join(sizes, "category").select(F.col("list").alias("_l"), F.col("category").alias("_cc"), _every("_nq").alias("_cb"), F.col("centroid").cast(small).alias("_c"))
    out = StructType().add("query_id", q.schema["_q"].dataType).add("category", q.schema["_qc"].dataType).add("cut", "double").add("cut_list", c.schema["_l"].dataType)
    schema = pa.schema(_arrow_schema(q.select(F.col("_q").alias("query_id"), F.col("_qc").alias("category"), F.lit(0.0).alias("cut")), c.select(F.col("_l").alias("cut_list"))))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.take(pc.sort_indices(right.column("_l")))
        most = math.ceil(right.num_rows * share)
        cuts, at = [], []
        for _, scores in _near_and_far(_matrix(left, "_v").astype(np.float64), _matrix(right, "_c").astype(np.float64)):
            cut = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
            needed = most - (scores > cut[:, None]).sum(axis=1)
            cuts.append(cut)
            at.append((np.cumsum(scores == cut[:, None], axis=1) >= needed[:, None]).argmax(axis=1))
        last = right.column("_l").take(pa.array(np.concatenate(at)))
        return pa.table([left.column("_q"), left.column("_qc"), pa.array(np.concatenate(cuts)), last], names=schema.names)

    return q.groupBy("_qc", "_qb").cogroup(c.groupBy("_cc", "_cb")).applyInArrow(find, out)


def _search_share(asked: DataFrame, centroids: DataFrame, stored: DataFrame, k: int, share: float, recall_k: int) -> DataFrame:
    """``search`` where a share of all lists is asked: blocks of queries meet blocks of products, and inside them only lists up to a query's last one.

    So a query is one row per block of products however many lists it asks, and a block, which has the whole vectors as well, gives the
    survivors' cosines. Listing (query, list) pairs would take space with the square of the table.
    """
    rows = asked.select("category", F.lit(1).alias("_q"), F.lit(0).alias("_p")).unionByName(stored.select("category", F.lit(0).alias("_q"), F.lit(1).alias("_p")))
    sizes = fetch_if_small(
        rows.groupBy("category").agg(_blocks(F.sum("_q"), QUERY_BLOCK).alias("_nq"), _blocks(F.sum("_p"), CATALOGUE_BLOCK).alias("_np")).where("_nq > 0 AND _np > 0")
    )
    small = "array<smallint>"
    cuts = last_probed(asked, centroids, share).drop("category")
    q = asked.join(cuts, "query_id").join(sizes, "category").select(
        F.col("query_id").alias("_q"), F.col("category").alias("_qc"), _block_of("query_id", "_nq").alias("_qb"), _every("_np").alias("_pb"),
        "cut", "cut_list", F.col("q").cast(small).alias("_i"), F.col("embedding").alias("_v"),
    )
    # Centroids join by list as well: where they are too many to be sent to all tasks, no category meets in one.
    listed = stored.join(centroids.select("category", "list", "centroid"), ["category", "list"]).join(sizes, "category")
    p = listed.select(
        F.col("product_id").alias("_p"), F.col("category").alias("_pc"), _every("_nq").alias("_qb2"), _block_of("product_id", "_np").alias("_pb2"),
        "list", "code", F.col("centroid").cast(small).alias("_c"), F.col("embedding").alias("_e"),
    )
    out = StructType().add("query_id", q.schema["_q"].dataType).add("product_id", p.schema["_p"].dataType).add("score", "double").add("full_score", "double")
    one = F.lit(0.0)
    schema = pa.schema(_arrow_schema(q.select(F.col("_q").alias("query_id")), p.select(F.col("_p").alias("product_id"), one.alias("score"), one.alias("full_score"))))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.take(pc.sort_indices(right.column("_p")))
        lists, first, own = np.unique(right.column("list").to_numpy(), return_index=True, return_inverse=True)
        centres = _matrix(right, "_c")
        guess = (centres + _matrix(right, "code").astype(np.int32) * STEP + STEP // 2).astype(np.float64)
        whole = _matrix(left, "_i").astype(np.float64)
        cut, cut_list = left.column("cut").to_numpy(), left.column("cut_list").to_numpy()
        found = []
        step = max(1, _TILE_CELLS // len(guess))
        for at, near in _near_and_far(whole, centres[first].astype(np.float64)):
            some = slice(at, at + len(near))
            asks = (near > cut[some, None]) | ((near == cut[some, None]) & (lists <= cut_list[some, None]))
            for start in range(0, len(asks), step):
                allowed = asks[start : start + step][:, own]
                scores = np.where(allowed, whole[at + start : at + start + len(allowed)] @ guess.T, -np.inf)
                i, j, vals = _best_per_row(scores, recall_k)
                kept = vals > -np.inf
                found.append((at + start + i[kept], j[kept], vals[kept]))
        i, j, vals = (np.concatenate(x) for x in zip(*found))
        cosines = _cosines(_matrix(left, "_v"), _matrix(right, "_e"), i, j)
        return pa.table([left.column("_q").take(pa.array(i)), right.column("_p").take(pa.array(j)), pa.array(vals), pa.array(cosines)], names=schema.names)

    pairs = q.groupBy("_qc", "_qb", "_pb").cogroup(p.groupBy("_pc", "_qb2", "_pb2")).applyInArrow(find, out)
    recalled = merge_topk(pairs, recall_k, ["full_score"])
    return merge_topk(recalled.select("query_id", "product_id", F.round("full_score", SCORE_DIGITS).alias("score")), k)


def _repeats(df: DataFrame, id_column: str) -> bool:
    return not df.groupBy(id_column).count().where("count > 1").isEmpty()


def search(
    queries: DataFrame, path: str, k: int, probes: int | float = 8, recall_k: int = 100, **blocks
) -> DataFrame:
    """(query_id, rank, product_id, score): approximate top ``k`` of the query's category, with exact cosines.

    The lists asked for reach the scan as a dynamic partition filter. Parts of about a block's rows are the keys of the
    block join, lists are matched inside them, and a crowded part is cut into blocks. ``recall_k`` products per query are scored again. ``probes`` is a number of lists,
    or below 1 the share of a category's lists: vectors without clusters need a share, clustered ones a few lists. A share is searched
    in blocks of the whole category (``_search_share``); repeated ids, which the rules above exclude, still take the way by pairs.
    """
    spark = queries.sparkSession
    centroids = spark.read.parquet(f"{path}/centroids")
    asked = queries.where(F.col("embedding").isNotNull()).withColumn("q", integer_unit()).where("q IS NOT NULL")
    stored = lists_of(spark, path)
    if probes < 1 and not _repeats(asked, "query_id") and not _repeats(stored, "product_id"):
        return _search_share(asked, centroids, stored, k, probes, recall_k)
    if probes < 1:
        counts = centroids.groupBy("category").agg(F.ceil(F.count(F.lit(1)) * F.lit(probes)).alias("_most"))
        most = counts.agg(F.max("_most")).first()[0] or 1
        nearest = nearest_lists(asked, centroids, most, "query_id").join(asked.select("query_id", "category"), "query_id")
        probed = nearest.join(counts, "category").where("place <= _most").select("query_id", "list")
    else:
        probed = nearest_lists(asked, centroids, probes, "query_id").drop("place")
    wanted = probed.select("list").distinct()
    near = stored.select("product_id", "category", "list", "code").join(wanted, "list").join(
        centroids.select("list", "centroid"), "list"
    )
    guess = F.zip_with("code", "centroid", lambda x, c: c.cast("long") + x.cast("long") * STEP + STEP // 2)
    # Lists are small, so about a block of them is matched in one call; a list stays whole.
    parts = fetch_if_small(stored.groupBy("category").agg(F.ceil(F.count(F.lit(1)) / CATALOGUE_BLOCK).alias("_parts")))
    part = F.pmod(F.xxhash64("list"), F.col("_parts")).alias("part")
    sought = asked.join(probed, "query_id").join(parts, "category")
    recalled = merge_topk(
        block_topk(
            sought.select("query_id", "category", part, "list", F.col("q").cast("array<bigint>").alias("embedding")),
            near.join(parts, "category").select("product_id", "category", part, "list", guess.alias("embedding")),
            recall_k, ["category", "part"], metric="dot", within="list", **blocks,
        ),
        recall_k,
    )
    whole = stored.select("product_id", "list", V.unit("embedding").alias("_p"))
    full = (
        recalled.select("query_id", "product_id")
        .join(whole.join(wanted, "list").drop("list"), "product_id")
        .join(asked.select("query_id", V.unit("embedding").alias("_q")), "query_id")
        .select("query_id", "product_id", F.round(V.dot("_q", "_p"), SCORE_DIGITS).alias("score"))
    )
    return merge_topk(full, k)

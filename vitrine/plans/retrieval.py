"""Registered retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import curate, infer, ivf, retrieve
from ..session import work_dir
from .inputs import DIM
from .registry import query, rounded

K = 20
RECALL_K = 50
SHORT = 16


def ranking_sql(
    queries: str = "f_queries", catalogue: str = "f_catalogue", k: int = K, dim: int | None = None,
    score: str | None = None, on: str = "USING (category)", qid: str = "q.query_id", where: str = "true",
) -> str:
    cut = f"[1:{dim}]" if dim else ""
    score = score or f"list_cosine_similarity(q.embedding{cut}, p.embedding{cut})"
    return f"""
SELECT query_id, rank, product_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id))::INT AS rank
  FROM (SELECT {qid} AS query_id, p.product_id, round({score}, 12) AS score
        FROM {queries} q JOIN {catalogue} p {on} WHERE {where}) s) r
WHERE rank <= {k}"""


def _shown(sql: str) -> str:
    return f"SELECT query_id, rank, product_id, round(score, 6) + 0 AS score FROM ({sql}) t"


def rerank_sql(candidates: str, k: int, weight: float) -> str:
    w = f"{weight}::DOUBLE"
    return f"""
SELECT query_id, rank, product_id, score, vector_score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id))::INT AS rank FROM (
    SELECT c.query_id, c.product_id, list_cosine_similarity(q.embedding, p.embedding) AS vector_score,
           round((1 - {w}) * list_cosine_similarity(q.embedding, p.embedding) + {w} * p.business_score, 12) AS score
    FROM ({candidates}) c JOIN f_queries q USING (query_id) JOIN f_catalogue p USING (product_id)) s) r
WHERE rank <= {k}"""


@query("exact_topk", _shown(ranking_sql()))
def exact_topk(i):
    return rounded(retrieve.exact_topk(i.queries(), i.catalogue(), K), "score")


@query("truncated_topk", _shown(ranking_sql(dim=SHORT)))
def truncated_topk(i):
    return rounded(retrieve.truncated_topk(i.queries(), i.catalogue(), K, SHORT), "score")


@query(
    "two_stage_search",
    "SELECT query_id, rank, product_id, round(score, 6) + 0 AS score, round(vector_score, 6) + 0 AS vector_score FROM ("
    + rerank_sql(ranking_sql(k=RECALL_K, dim=SHORT, where="p.in_stock"), K, 0.15) + ") t",
)
def two_stage_search(i):
    ranked = retrieve.two_stage_search(i.queries(), i.catalogue(), RECALL_K, SHORT, K, 0.15)
    return rounded(ranked, "score", "vector_score")


@query(
    "regional_search",
    "SELECT query_id, rank, product_id, round(score, 6) + 0 AS score, round(vector_score, 6) + 0 AS vector_score FROM ("
    + rerank_sql(ranking_sql(k=RECALL_K, dim=SHORT, where="p.in_stock AND p.region = 'JP'"), K, 0.15) + ") t",
)
def regional_search(i):
    ranked = retrieve.two_stage_search(i.queries(), i.catalogue(), RECALL_K, SHORT, K, 0.15, region="JP")
    return rounded(ranked, "score", "vector_score")


_GARMENTS = """
SELECT query_id // 3 AS image_id, (query_id % 3)::INT AS item_index,
       CASE WHEN label = 0 THEN 'scarf' WHEN label = 1 THEN NULL ELSE category END AS category, embedding FROM f_queries"""


@query(
    "multi_item_search",
    f"""
WITH items AS ({_GARMENTS}),
known AS (SELECT DISTINCT category, true AS is_known FROM f_catalogue),
asked AS (SELECT i.*, i.image_id * 3 + i.item_index AS query_id, coalesce(k.is_known, false) AS is_known
          FROM items i LEFT JOIN known k USING (category))
SELECT query_id // 3 AS image_id, (query_id % 3)::INT AS item_index, rank, product_id, round(score, 6) + 0 AS score
FROM ({ranking_sql('asked', k=12, on="ON q.category = p.category OR NOT q.is_known")}) t""",
)
def multi_item_search(i):
    """Three queries form one image; some garments have an unknown or no category."""
    garments = i.queries().selectExpr(
        "query_id div 3 AS image_id", "cast(query_id % 3 AS int) AS item_index",
        "CASE WHEN label = 0 THEN 'scarf' WHEN label = 1 THEN NULL ELSE category END AS category", "embedding",
    )
    return rounded(retrieve.multi_item_search(garments, i.catalogue(), 12), "score")


_INT8_UNIT = "list_transform({v}, lambda x: round(x / sqrt(list_inner_product({v}, {v})) * 127))"


@query(
    "int8_topk",
    _shown(
        "WITH q8 AS (SELECT query_id, category, " + _INT8_UNIT.format(v="embedding") + " AS embedding FROM f_queries), "
        "p8 AS (SELECT product_id, category, " + _INT8_UNIT.format(v="embedding") + " AS embedding FROM f_catalogue) "
        + ranking_sql("q8", "p8", score="list_inner_product(q.embedding, p.embedding)")
    ).replace("round(score, 6)", "round(score / 16129, 6)"),
)
def int8_topk(i):
    return rounded(retrieve.int8_topk(i.queries(), i.catalogue(), K), "score")


_SIGNS = "list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1::DOUBLE ELSE -1::DOUBLE END)"


@query(
    "binary_rerank",
    f"""
WITH qs AS (SELECT query_id, category, {_SIGNS} AS embedding FROM f_queries),
ps AS (SELECT product_id, category, {_SIGNS} AS embedding FROM f_catalogue)
SELECT query_id, rank, product_id, round(score, 6) + 0 AS score
FROM ({rerank_sql(ranking_sql('qs', 'ps', k=RECALL_K, score='list_inner_product(q.embedding, p.embedding)'), K, 0.0)}) t""",
)
def binary_rerank(i):
    return rounded(retrieve.binary_rerank(i.queries(), i.catalogue(), DIM, RECALL_K, K), "score")


# The test vectors have no clusters, so a share of the lists is asked.
LISTED, PROBES, ROUNDS, CODED_K = 16, 0.7, 2, 60
_INTEGERS = "list_transform(embedding, lambda x: floor(x / sqrt(list_inner_product(embedding, embedding)) * 1024))"


def _nearest(rows: str, centroids: str, n: float, key: str) -> str:
    most = n if n >= 1 else f"ceil((SELECT count(*) FROM {centroids} x WHERE x.category = t.category) * {n}::DOUBLE)"
    return f"""
  SELECT {key}, category, list, centroid FROM (
    SELECT r.{key}, r.category, c.list, c.centroid, row_number() OVER (
      PARTITION BY r.{key} ORDER BY 2 * list_inner_product(r.q, c.centroid) - list_inner_product(c.centroid, c.centroid) DESC, c.list) AS place
    FROM {rows} r JOIN {centroids} c USING (category)) t WHERE place <= {most}"""


def _round_sql(n: int) -> str:
    """Centroids after one more round: the integer mean of each component over the rows of the nearest list."""
    return f"""
dealt{n} AS MATERIALIZED ({_nearest("rows", f"centroids{n - 1}", 1, "product_id")}),
centroids{n} AS MATERIALIZED (
  SELECT category, list, list(floor(total / n) ORDER BY place) AS centroid FROM (
    SELECT category, list, place, sum(x) AS total, count(*) AS n FROM (
      SELECT d.category, d.list, unnest(r.q) AS x, generate_subscripts(r.q, 1) AS place
      FROM dealt{n} d JOIN rows r USING (product_id)) u GROUP BY category, list, place) s GROUP BY category, list)"""


def index_sql(k: int) -> str:
    """The whole index and its search, recomputed: seeds, rounds of k-means, codes, probes, codes scored, rescored."""
    return f"""
WITH rows AS MATERIALIZED (SELECT product_id, category, embedding, {_INTEGERS} AS q FROM f_catalogue),
asked AS MATERIALIZED (SELECT query_id, category, embedding, {_INTEGERS} AS q FROM f_queries),
centroids0 AS MATERIALIZED (
  SELECT category, product_id AS list, q AS centroid FROM rows JOIN (SELECT category, min(product_id) AS least FROM rows GROUP BY category) m USING (category)
  WHERE ('0x' || substr(md5(product_id::VARCHAR), 1, 8))::BIGINT % 65536 < {65536 // LISTED} OR product_id = least),
{",".join(_round_sql(n) for n in range(1, ROUNDS + 1))},
listed AS MATERIALIZED (
  SELECT d.product_id, d.category, d.list, r.embedding,
         list_transform(list_zip(r.q, d.centroid), lambda z: z[2] + greatest(-128, least(127, floor((z[1] - z[2]) / 16))) * 16 + 8) AS guess
  FROM ({_nearest("rows", f"centroids{ROUNDS}", 1, "product_id")}) d JOIN rows r USING (product_id)),
probed AS MATERIALIZED ({_nearest("asked", f"centroids{ROUNDS}", PROBES, "query_id")}),
coded AS MATERIALIZED (
  SELECT a.query_id, l.product_id, l.embedding AS p, a.embedding AS q
  FROM probed b JOIN asked a USING (query_id) JOIN listed l ON l.category = b.category AND l.list = b.list
  QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY list_inner_product(a.q, l.guess) DESC, l.product_id) <= {CODED_K})
SELECT query_id, rank, product_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id))::INT AS rank
  FROM (SELECT query_id, product_id, round(list_cosine_similarity(q, p), 12) AS score FROM coded) s) r
WHERE rank <= {k}"""


def _indexed(i):
    """Search over an index that is built below the work folder; a standing index would be built once."""
    path = work_dir(i.spark, "index")
    ivf.build(i.catalogue(), path, DIM, rows_per_list=LISTED, rounds=ROUNDS)
    return ivf.search(i.queries(), path, 10, probes=PROBES, recall_k=CODED_K)


@query("ann_topk", _shown(index_sql(10)))
def ann_topk(i):
    return rounded(_indexed(i), "score")


@query(
    "ann_recall",
    f"""
WITH exact AS ({ranking_sql(k=10)}), approximate AS ({index_sql(10)})
SELECT count(*) AS n_exact, count(a.product_id) AS n_found, round(count(a.product_id) / count(*), 6) + 0 AS recall
FROM exact e LEFT JOIN approximate a USING (query_id, product_id)""",
)
def ann_recall(i):
    """Share of the exact top 10 that the index returns."""
    exact = retrieve.exact_topk(i.queries(), i.catalogue(), 10)
    return rounded(retrieve.recall_against(exact, _indexed(i)), "recall")


@query("hashed_topk")
def hashed_topk(i):
    # A few hundred vectors per category fill few buckets; a large catalogue takes more bits.
    return rounded(retrieve.ann_topk(i.queries(), i.catalogue(), 10, DIM, bits=4, tables=8, probes=3), "score")


@query(
    "catalogue_vectors",
    """
SELECT p.product_id, p.category, p.brand, p.in_stock, p.region, round(p.price, 2) AS price, len(e.embedding)::INT AS dim,
       round(sqrt(list_inner_product(e.embedding, e.embedding)), 6) AS norm
FROM f_products p JOIN f_catalogue e USING (product_id)""",
)
def catalogue_vectors(i):
    joined = retrieve.catalogue_vectors(i.catalogue().select("product_id", "embedding"), i.products())
    return joined.select(
        "product_id", "category", "brand", "in_stock", "region", F.round("price", 2).alias("price"),
        F.size("embedding").alias("dim"), F.round(V.norm("embedding"), 6).alias("norm"),
    )


@query(
    "hit_report",
    f"""
WITH ranked AS ({ranking_sql()}),
first AS (SELECT query_id, min(rank) AS first_rank FROM ranked JOIN f_relevance USING (query_id, product_id) GROUP BY query_id),
asked AS (SELECT DISTINCT r.query_id, q.category FROM f_relevance r JOIN f_queries q USING (query_id))
SELECT category, count(*) AS n_queries, count(first_rank) AS n_hits, round(count(first_rank) / count(*), 6) AS hit_rate,
       floor(quantile_cont(first_rank, 0.5))::INT AS median_rank
FROM asked LEFT JOIN first USING (query_id) GROUP BY category""",
)
def hit_report(i):
    results = retrieve.exact_topk(i.queries(), i.catalogue(), K)
    judged = i.relevance().join(i.queries().select("query_id", "category"), "query_id")
    return rounded(retrieve.hit_report(results, judged, ["category"]), "hit_rate")


@query(
    "mined_negatives",
    f"""
SELECT query_id, rank, product_id, round(score, 6) + 0 AS score FROM ({ranking_sql(k=50)}) t
WHERE NOT EXISTS (SELECT 1 FROM f_relevance r WHERE r.query_id = t.query_id AND r.product_id = t.product_id)""",
)
def mined_negatives(i):
    return rounded(curate.mine_hard_negatives(i.queries(), i.catalogue(), i.relevance()), "score").select(
        "query_id", "rank", "product_id", "score"
    )


@query(
    "embedding_contract",
    """
SELECT label, count(*) AS n_vectors, count(*) FILTER (len(embedding) <> 64) AS wrong_dimension,
       count(*) FILTER (abs(sqrt(list_inner_product(embedding, embedding)) - 1) >= 0.001) AS wrong_norm,
       count(*) FILTER (len(embedding) <> 64 OR abs(sqrt(list_inner_product(embedding, embedding)) - 1) >= 0.001) = 0 AS passed
FROM f_queries GROUP BY label""",
)
def embedding_contract(i):
    """Checks the perturbed queries: those with added noise are no longer unit vectors."""
    return infer.embedding_contract(i.queries(), DIM, 1e-3, ["label"])

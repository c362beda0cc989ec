"""Registered curation, evaluation-set and click-feedback queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import CATEGORIES
from ..operators import curate, infer
from ..sources import pairs as pair_source, runs
from .inputs import AS_OF, DIM, RUN
from .registry import query, rounded

# Joined pairs before the ambiguity filter; n is the size of the (post, category) group.
_JOINED = """
SELECT d.detection_id AS pair_id, p.product_id, d.post_id, p.image_path AS positive_path, d.category, d.score, d.area_frac,
       count(*) OVER (PARTITION BY d.post_id, d.category) AS n
FROM f_detections d JOIN f_linked_products p ON p.post_id = d.post_id AND p.category = d.category
WHERE d.score >= 0.45 AND p.license_ok"""
_PAIR = "pair_id, product_id, post_id, positive_path, category"
_PAIR_SCORES = "round(score, 6) AS score, round(area_frac, 6) AS area_frac"
_PAIRS = f"SELECT {_PAIR}, score, area_frac FROM ({_JOINED}) j WHERE n = 1"
_CLICKS = f"""
SELECT concat('click_', event_id, '_', c.product_id) AS pair_id, c.product_id, event_id AS post_id, query_image AS anchor_path,
       p.image_path AS positive_path, selected_category AS category, 1.0::DOUBLE AS score, 0.0::DOUBLE AS area_frac
FROM (SELECT *, unnest(clicked) AS product_id FROM f_events
      WHERE query_image IS NOT NULL AND event_ts >= DATE '{AS_OF}' - INTERVAL 30 DAY) c JOIN f_products p USING (product_id)"""


def _bucket_sql(key: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % 1000"


def _build(i):
    return curate.build_pairs(i.detections(), i.post_products(), i.products())


@query("build_pairs", f"SELECT {_PAIR}, {_PAIR_SCORES} FROM ({_PAIRS}) t")
def build_pairs(i):
    return rounded(_build(i), "score", "area_frac")


@query("ambiguous_pairs", f"SELECT post_id, category, max(n) AS n_pairs FROM ({_JOINED}) j WHERE n > 1 GROUP BY post_id, category")
def ambiguous_pairs(i):
    return curate.ambiguous_groups(i.detections(), i.post_products(), i.products())


_NEAR = """
WITH allv AS (SELECT product_id, category, embedding FROM f_catalogue UNION ALL SELECT product_id, category, embedding FROM f_near_copies)
SELECT DISTINCT b.product_id AS drop_id FROM allv a JOIN allv b ON a.category = b.category AND a.product_id < b.product_id
WHERE round(list_cosine_similarity(a.embedding, b.embedding), 12) >= 0.97"""


def _with_copies(i):
    return i.catalogue().select("product_id", "category", "embedding").unionByName(i.near_copies())


@query("near_dup", _NEAR)
def near_dup(i):
    return curate.near_duplicates(_with_copies(i))


@query("near_dup_hashed", _NEAR)
def near_dup_hashed(i):
    # Few bits, as a category here has few vectors: one copy in a million would be missed.
    return curate.near_duplicates_hashed(_with_copies(i), DIM, bits=4, tables=10)


# Every vector twice: under an even id and, as a supplier's near copy, under the next odd id.
_SUPPLIED = """
supplied AS (SELECT product_id * 2 AS product_id, category, embedding FROM f_catalogue
             UNION ALL SELECT (product_id - 1000000) * 2 + 1, category, embedding FROM f_near_copies),
dropped AS (SELECT DISTINCT b.product_id FROM supplied a JOIN supplied b ON a.category = b.category AND a.product_id < b.product_id
            WHERE round(list_cosine_similarity(a.embedding, b.embedding), 12) >= 0.97)"""


@query(
    "pairs_deduped",
    f"WITH {_SUPPLIED} SELECT {_PAIR}, {_PAIR_SCORES} FROM ({_PAIRS}) t WHERE product_id NOT IN (SELECT product_id FROM dropped)",
)
def pairs_deduped(i):
    columns = ["product_id", "category", "embedding"]
    originals = i.catalogue().select(*columns).withColumn("product_id", F.col("product_id") * 2)
    copies = i.near_copies().withColumn("product_id", (F.col("product_id") - 1_000_000) * 2 + 1)
    drops = curate.near_duplicates(originals.unionByName(copies))
    return rounded(curate.drop_products(_build(i), drops), "score", "area_frac")


@query(
    "pairs_with_clicks",
    f"SELECT {_PAIR}, {_PAIR_SCORES} FROM (SELECT {_PAIR}, score, area_frac FROM ({_PAIRS}) t UNION ALL SELECT {_PAIR}, score, area_frac FROM ({_CLICKS}) c) u",
)
def pairs_with_clicks(i):
    clicks = curate.click_pairs(i.events(), i.products(), AS_OF, max_pairs=None)
    return rounded(curate.with_clicks(_build(i), clicks), "score", "area_frac")


@query("product_split", f"SELECT {_PAIR}, CASE WHEN {_bucket_sql('product_id')} < 80 THEN 'eval' ELSE 'train' END AS split FROM ({_PAIRS}) t")
def product_split(i):
    return curate.split_by_key(_build(i), mode="md5").drop("score", "area_frac")


def _leak_sql(key: str) -> str:
    return f"""
WITH s AS (SELECT product_id, CASE WHEN {_bucket_sql(key)} < 80 THEN 'eval' ELSE 'train' END AS split FROM ({_PAIRS}) t)
SELECT count(*) AS n_overlap FROM (SELECT product_id FROM s WHERE split = 'train' INTERSECT SELECT product_id FROM s WHERE split = 'eval') o"""


def _leak(i, key: str):
    split = curate.split_by_key(_build(i), key, mode="md5")
    return curate.leakage(split.where("split = 'train'"), split.where("split = 'eval'"))


@query("leakage", _leak_sql("product_id"))
def leakage(i):
    """Products on both sides of the split by product; must be none."""
    return _leak(i, "product_id")


@query("row_split_leakage", _leak_sql("pair_id"))
def row_split_leakage(i):
    """The same check on a split by row, which does leak."""
    return _leak(i, "pair_id")


@query(
    "pair_stats",
    f"""
SELECT CASE WHEN {_bucket_sql('product_id')} < 80 THEN 'eval' ELSE 'train' END AS split, category, count(*) AS n_pairs
FROM ({_PAIRS}) t GROUP BY ALL""",
)
def pair_stats(i):
    return curate.pair_stats(curate.split_by_key(_build(i), mode="md5"), ["split", "category"])


_HELD_OUT = f"""
SELECT l.post_id, p.category, l.product_id FROM f_post_products l JOIN f_products p USING (product_id)
WHERE {_bucket_sql('l.product_id')} < 80"""


def _judgments(i):
    return curate.prepare_eval_set(i.post_products(), i.products(), 80, "md5")


@query(
    "eval_set",
    f"""
SELECT DISTINCT post_id, category, product_id, 1.0::DOUBLE AS grade, 'styled_post' AS query_condition, 'unknown' AS size_band, 'unknown' AS occlusion
FROM ({_HELD_OUT}) h""",
)
def eval_set(i):
    """One row per judgment, whatever the size of a query's relevant set."""
    return _judgments(i).select("post_id", "category", "product_id", "grade", "query_condition", "size_band", "occlusion").distinct()


@query(
    "slice_coverage",
    """
WITH guard(slice_dim, slice_value) AS (VALUES ('category', 'bag'), ('category', 'hat'), ('size_band', 'small'), ('occlusion', 'heavy'), ('category', 'scarf')),
n AS (SELECT 'category' AS slice_dim, category AS slice_value, count(*) AS n FROM f_queries GROUP BY 2
      UNION ALL SELECT 'size_band', size_band, count(*) FROM f_queries GROUP BY 2
      UNION ALL SELECT 'occlusion', occlusion, count(*) FROM f_queries GROUP BY 2),
c AS (SELECT slice_dim, slice_value, coalesce(n, 0) AS n_queries, coalesce(n, 0) / (SELECT count(*) FROM f_queries) AS share
      FROM guard LEFT JOIN n USING (slice_dim, slice_value))
SELECT slice_dim, slice_value, n_queries, round(share, 6) + 0 AS share, CASE WHEN n_queries >= 60 THEN 'OK' ELSE 'TOO FEW' END AS status,
       CASE WHEN n_queries < 60 AND share > 0 THEN floor(60 / share * 1.15::DOUBLE)::BIGINT END AS needed FROM c""",
)
def slice_coverage(i):
    protected = [("category", "bag"), ("category", "hat"), ("size_band", "small"), ("occlusion", "heavy"), ("category", "scarf")]
    return rounded(curate.slice_coverage(i.queries(), protected, 60), "share")


_BEST = """
SELECT post_id, arg_min(detection_id, (-area_frac * score, detection_id)) AS detection_id,
       arg_min(area_frac, (-area_frac * score, detection_id)) AS area_frac FROM f_detections GROUP BY post_id"""
_BANDS = """
CASE WHEN {a} < 0.08::DOUBLE THEN 'small' WHEN {a} < 0.30::DOUBLE THEN 'medium' ELSE 'large' END AS size_band,
CASE WHEN {a} < 0.05::DOUBLE THEN 'heavy' ELSE 'none' END AS occlusion"""


@query(
    "fold_labels",
    f"""
SELECT e.post_id, e.category, e.product_id, coalesce(b.size_band, 'unknown') AS size_band, coalesce(b.occlusion, 'unknown') AS occlusion
FROM ({_HELD_OUT}) e LEFT JOIN (SELECT post_id, {_BANDS.format(a='area_frac')} FROM ({_BEST}) x WHERE area_frac < 0.4) b USING (post_id)""",
)
def fold_labels(i):
    """Labels from each post's best box; posts whose best box is huge stay unlabelled."""
    labels = curate.with_slice_labels(infer.best_box(i.detections()).where("area_frac < 0.4"))
    return curate.fold_slice_labels(_judgments(i), labels).select("post_id", "category", "product_id", "size_band", "occlusion")


@query("slice_labels", f"SELECT detection_id, round(area_frac, 6) AS area_frac, {_BANDS.format(a='area_frac')} FROM f_detections")
def slice_labels(i):
    return rounded(curate.with_slice_labels(i.detections()), "area_frac").select("detection_id", "area_frac", "size_band", "occlusion")


@query(
    "detect_filter",
    "SELECT detection_id, category, round(score, 6) AS score, round(area_frac, 6) AS area_frac FROM f_detections WHERE score >= 0.4 AND area_frac >= 0.02",
)
def detect_filter(i):
    return rounded(curate.keep_detections(i.detections(), 0.40, 0.02), "score", "area_frac").drop("post_id")


@query("click_pairs", f"SELECT * EXCLUDE (score, area_frac), {_PAIR_SCORES} FROM ({_CLICKS}) t")
def click_pairs(i):
    return rounded(curate.click_pairs(i.events(), i.products(), AS_OF, max_pairs=None), "score", "area_frac")


@query(
    "click_harvest",
    f"""
SELECT pair_id, product_id, post_id FROM ({_CLICKS.replace('SELECT concat', 'SELECT event_ts, concat', 1)}) t
ORDER BY event_ts DESC, post_id, product_id LIMIT 500""",
)
def click_harvest(i):
    """A top list: the newest 500 click pairs. ``click_pairs`` has them all."""
    return curate.click_pairs(i.events(), i.products(), AS_OF, max_pairs=500).select("pair_id", "product_id", "post_id")


@query(
    "hard_negatives",
    f"""
SELECT event_id, query_image AS anchor_path, results_shown[pos + 1] AS negative_product_id, pos::INT AS shown_rank
FROM (SELECT *, unnest(range(least(len(results_shown), 5))) AS pos FROM f_events
      WHERE len(clicked) > 0 AND query_image IS NOT NULL AND event_ts >= DATE '{AS_OF}' - INTERVAL 30 DAY) t
WHERE NOT list_contains(clicked, results_shown[pos + 1])""",
)
def hard_negatives(i):
    return curate.hard_negatives(i.events(), AS_OF)


@query(
    "sample_queries",
    "SELECT query_id, category FROM f_queries WHERE category = 'bag' ORDER BY md5(query_id::VARCHAR || '#42'), query_id LIMIT 25",
)
def sample_queries(i):
    return curate.sample_rows(i.queries(), "query_id", 25, 42, "bag").select("query_id", "category")


@query(
    "ingest_pairs",
    """
SELECT concat('p', k) AS product_id, concat('post_p', k) AS post_id, shop_thumb AS positive_path, street_crop AS anchor_path,
       ['bag', 'bottom', 'dress', 'hat', 'outer', 'shoes', 'top'][class_label + 1] AS category, 'KRW' AS currency, 'KR' AS region,
       true AS in_stock, true AS license_ok
FROM (SELECT *, CASE WHEN length(pair_key) < 7 THEN lpad(pair_key, 7, '0') ELSE pair_key END AS k FROM f_image_pairs
      WHERE street_crop IS NOT NULL AND shop_thumb IS NOT NULL) t""",
)
def ingest_pairs(i):
    incoming = i.image_pairs()
    roles = pair_source.infer_roles(incoming.schema, ["street_crop", "shop_thumb"])
    category = pair_source.decode_category(incoming, roles["category"], CATEGORIES)
    products, posts = pair_source.ingest_pairs(
        incoming, "pair_key", roles["anchor"], roles["positive"], category, "line-items", AS_OF
    )
    # The link back to the product is the post's only array element.
    links = posts.select("post_id", F.col("image_path").alias("anchor_path"), F.explode("linked_products").alias("product_id")).distinct()
    described = products.select("product_id", F.col("image_path").alias("positive_path"), "category", "currency", "region", "in_stock", "license_ok")
    return described.join(links, "product_id")


@query(
    "category_quality",
    """
SELECT category, count(*) AS n, coalesce(regexp_full_match(category, '[0-9]+'), false) AS is_numeric
FROM (SELECT CASE WHEN in_stock THEN category ELSE (product_id % 7)::VARCHAR END AS category FROM f_products) t GROUP BY category""",
)
def category_quality(i):
    """Products out of stock carry undecoded labels, which the report must flag."""
    raw = i.products().selectExpr("CASE WHEN in_stock THEN category ELSE cast(product_id % 7 AS string) END AS category")
    return pair_source.category_quality(raw)


@query(
    "resolve_paths",
    """
SELECT e.product_id, coalesce(s.path, concat('marker://run-2/', e.product_id)) AS image_path, s.path IS NOT NULL AS is_viewable
FROM f_catalogue e LEFT JOIN (SELECT product_id, image_path AS path FROM f_products WHERE image_path LIKE 'img/%') s USING (product_id)""",
)
def resolve_paths(i):
    shipped = runs.viewable(i.products()).select("product_id", F.col("image_path").alias("path"))
    paths = runs.resolve_image_path(i.catalogue().select("product_id"), shipped, RUN)
    return paths.withColumn("is_viewable", ~F.col("image_path").startswith(runs.MARKER))


@query(
    "rebuild_eval",
    """
SELECT concat('post_', query_id) AS post_id, concat('marker://run-2/post_', query_id) AS query_image, category,
       query_id::VARCHAR AS relevant_ids, 1.0::DOUBLE AS grade, 'styled_post' AS query_condition, size_band, occlusion FROM f_queries""",
)
def rebuild_eval(i):
    delivered = i.queries().selectExpr("query_id AS product_id", "concat('post_', query_id) AS post_id", "category", "size_band", "occlusion")
    none_shipped = i.products().where("false").select("product_id", F.col("image_path").alias("path"))
    delivered = runs.resolve_image_path(delivered, none_shipped, RUN, prefix="post_")
    return runs.rebuild_eval_queries(delivered, AS_OF).select(
        "post_id", "query_image", "category", F.array_join("relevant_ids", ",").alias("relevant_ids"),
        F.element_at(F.map_values("relevance_map"), 1).alias("grade"), "query_condition", "size_band", "occlusion",
    )


@query(
    "post_links",
    "SELECT post_id, product_id FROM f_post_products",
)
def post_links(i):
    """Posts and their products in long form; ``skew.nest_in_chunks`` makes arrays at an edge that wants them."""
    return i.post_products().select("post_id", "product_id")

"""Registered batch-inference and run-ingestion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import infer
from ..session import work_dir
from ..sources import runs
from .inputs import DIM
from .models import box_detector, text_encoder
from .registry import query, rounded

ENCODER = "bow:v2"

# One row per document: its hashed word counts as a list of 64, normalised.
_BOW = """
SELECT doc_id, sqrt(sum(n * n)) AS norm, count(*) AS dims, sum((slot + 1) * n) AS weighted FROM (
  SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 64 AS slot, count(*) AS n
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents WHERE text <> '') w GROUP BY ALL) s
GROUP BY doc_id"""
_CHECK = "dims, round(weighted / norm, 6) + 0 AS checksum"


def _checked(df):
    """Number of used dimensions and a position-weighted sum instead of the vector itself."""
    positions = F.sequence(F.lit(1), F.size("embedding"))
    weighted = F.aggregate(F.zip_with("embedding", positions, lambda x, p: x * p), F.lit(0.0), lambda a, x: a + x)
    used = F.size(F.filter("embedding", lambda x: x != 0)).cast("bigint")
    return rounded(df.withColumns({"dims": used, "checksum": weighted}).drop("embedding"), "checksum")


def _embed(items, existing):
    return infer.embed_incremental(items, existing, text_encoder, ENCODER, "doc_id", ["text"])


@query(
    "incremental_embed",
    f"""
SELECT doc_id, '{ENCODER}' AS encoder_uri, {_CHECK} FROM ({_BOW}) b
WHERE doc_id NOT IN (SELECT doc_id FROM f_stored_documents WHERE encoder_uri = '{ENCODER}')""",
)
def incremental_embed(i):
    """Documents never embedded, and those of the previous encoder."""
    return _checked(_embed(i.raw("documents"), i.stored_documents()))


@query(
    "merge_embeddings",
    f"""
SELECT encoder_uri, count(*) AS n FROM (
  SELECT doc_id, encoder_uri FROM f_stored_documents WHERE encoder_uri = '{ENCODER}'
  UNION ALL SELECT doc_id, encoder_uri FROM f_stored_documents WHERE encoder_uri <> '{ENCODER}'
    AND doc_id IN (SELECT doc_id FROM documents WHERE text IS NULL OR text = '')
  UNION ALL SELECT doc_id, '{ENCODER}' FROM documents WHERE text <> ''
    AND doc_id NOT IN (SELECT doc_id FROM f_stored_documents WHERE encoder_uri = '{ENCODER}')) t GROUP BY encoder_uri""",
)
def merge_embeddings(i):
    """After an encoder change the new vectors replace the old ones."""
    fresh = _embed(i.raw("documents"), i.stored_documents()).select("doc_id", "encoder_uri")
    merged = infer.merge_embeddings(i.stored_documents(), fresh, "doc_id")
    return merged.groupBy("encoder_uri").agg(F.count(F.lit(1)).alias("n"))


@query(
    "detect_job",
    """
SELECT substr(sha256(concat_ws('|', post_id, label, printf('%.1f', x1), printf('%.1f', y1))), 1, 24) AS detection_id, post_id, category,
       round(score, 6) AS score, x1, y1, x1 + w AS x2, y1 + h AS y2, round(w * h / 40000, 6) AS area_frac
FROM (SELECT post_id, (post_id + nth) % 7 AS label, ['bag', 'bottom', 'dress', 'hat', 'outer', 'shoes', 'top'][(post_id + nth) % 7 + 1] AS category,
             ((post_id + nth * 17) % 100) / 100.0::DOUBLE AS score, ((cust * 7 + nth * 13) % 100)::DOUBLE AS x1,
             ((post_id * 3 + nth * 5) % 100)::DOUBLE AS y1, (10 + post_id % 90)::DOUBLE AS w, (10 + cust % 80)::DOUBLE AS h
      FROM (SELECT o_orderkey AS post_id, o_custkey AS cust, unnest(range(o_orderkey % 4)) AS nth FROM orders) n) b
WHERE score >= 0.4 AND w * h / 40000 >= 0.008""",
)
def detect_job(i):
    images = i.raw("orders").select(F.col("o_orderkey").alias("post_id"), "o_custkey")
    return rounded(infer.detect_items(images, box_detector, ["o_custkey"]), "score", "area_frac")


# A box per line item on an image of 200 x 200: where it lies follows from part and supplier, its size from quantity and tax.
_BOX = [
    "l_orderkey AS post_id", "cast(l_partkey % 7 AS int) AS label", "l_returnflag AS category", "round(l_discount * 10, 2) AS score",
    "cast(l_partkey % 100 AS double) AS x1", "cast(l_suppkey % 100 AS double) AS y1",
    "cast(l_partkey % 100 AS double) + l_quantity AS x2", "cast(l_suppkey % 100 AS double) + round(l_tax * 1000) AS y2",
]


@query(
    "delivered_boxes",
    f"""
SELECT substr(sha256(concat_ws('|', post_id, label, printf('%.1f', x1), printf('%.1f', y1))), 1, 24) AS detection_id, post_id, category,
       round(score, 6) + 0 AS score, x1, y1, x2, y2, round((x2 - x1) * (y2 - y1) / 40000::DOUBLE, 6) + 0 AS area_frac
FROM (SELECT {", ".join(_BOX)} FROM lineitem) b
WHERE x2 > x1 AND y2 > y1 AND score >= 0.4 AND (x2 - x1) * (y2 - y1) / 40000::DOUBLE >= 0.008""",
)
def delivered_boxes(i):
    """Ids, areas and floors for the boxes of a delivery."""
    boxes = i.raw("lineitem").selectExpr(*_BOX)
    return rounded(infer.keep_boxes(boxes, 200.0, 200.0), "score", "area_frac")


@query(
    "best_box",
    """
SELECT post_id, detection_id, category, round(score, 6) AS score, round(area_frac, 6) AS area_frac FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY -area_frac * score, detection_id) AS place FROM f_detections) t WHERE place = 1""",
)
def best_box(i):
    return rounded(infer.best_box(i.detections()), "score", "area_frac")


_ITEMS = """
SELECT p.post_id, coalesce(d.place - 1, 0)::INT AS item_index, d.category, coalesce(d.score, 0) AS score, coalesce(d.area_frac, 1) AS area_frac,
       d.place IS NULL AS used_whole_image
FROM f_posts p LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY area_frac * score DESC, detection_id) AS place
  FROM f_detections WHERE score > 0.6) d USING (post_id)"""


def _items(i):
    return infer.expand_items(i.posts(), i.detections().where("score > 0.6"))


@query("multi_item", f"SELECT post_id, item_index, category, round(score, 6) AS score, round(area_frac, 6) AS area_frac, used_whole_image FROM ({_ITEMS}) t")
def multi_item(i):
    return rounded(_items(i), "score", "area_frac")


@query(
    "fallback_rate",
    f"SELECT count(*) AS n_images, round(avg(used_whole_image::INT), 4) AS fallback_rate FROM ({_ITEMS}) t WHERE item_index = 0",
)
def fallback_rate(i):
    return infer.fallback_rate(_items(i))


_CHECKS = [
    ("embedding_dim", "embedding_dim::VARCHAR", "64", "embedding_dim = 64", "fatal"),
    ("encoder_repo", "encoder_repo", "encoder-a", "encoder_repo = 'encoder-a'", "fatal"),
    ("n_products", "n_products::VARCHAR", "50", "n_products >= 50 * 0.9", "fatal"),
    ("device", "device", "cuda", "device = 'cuda'", "note"),
]


@query(
    "manifest_check",
    " UNION ALL ".join(
        f"SELECT stamp, '{n}' AS \"check\", {o} AS observed, '{e}' AS expected, {p} AS passed, '{s}' AS severity FROM f_run_manifests"
        for n, o, e, p, s in _CHECKS
    ),
)
def manifest_check(i):
    return runs.check_manifest(i.run_manifests(), DIM, "encoder-a", 50)


@query(
    "run_contents",
    """
SELECT m.stamp, m.n_products AS claimed, r.n AS delivered, r.lo AS embedding_dim, r.hi AS max_dim
FROM f_run_manifests m JOIN (SELECT stamp, count(*) AS n, min(len(embedding))::INT AS lo, max(len(embedding))::INT AS hi
                             FROM f_run_products GROUP BY stamp) r USING (stamp)""",
)
def run_contents(i):
    """What each run claims against what it contains."""
    real = runs.measure_run(i.run_products(), ["stamp"]).withColumnRenamed("n_products", "delivered")
    return i.run_manifests().select("stamp", F.col("n_products").alias("claimed")).join(real, "stamp")


@query("latest_run", "SELECT product_id, category, 64 AS dim, '20240125T060000' AS stamp FROM f_catalogue")
def latest_run(i):
    """Two runs are delivered to an inbox; the newer one holds the full vectors."""
    inbox = work_dir(i.spark, "inbox")
    columns = ["product_id", "category", "embedding"]
    for stamp, dim in [("20240125T060000", DIM), ("20240110T060000", 16)]:
        products = i.catalogue().select(*columns).withColumn("embedding", V.truncate("embedding", dim))
        queries = i.queries().select("query_id", "embedding")
        manifest = products.agg(F.count(F.lit(1)).alias("n_products"), F.max(F.size("embedding")).alias("embedding_dim"))
        runs.write_run(products, queries, manifest, inbox, stamp)
    stamp, products, _ = runs.latest_run(i.spark, inbox)
    return products.select("product_id", "category", F.size("embedding").alias("dim"), F.lit(stamp).alias("stamp"))

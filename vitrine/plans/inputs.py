"""Operator inputs derived from the given tables, each over the whole table.

Every input exists twice: as a DataFrame here and as a DuckDB query in
``INPUT_SQL``, which the oracles use as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import monitor

AS_OF = "2024-01-31"
DIM = 64
RUN = "run-2"

_NAMES = ["top", "bottom", "outer", "dress", "shoes", "bag", "hat", "top", "bottom", "outer"]


def _category(key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES))
    return f"CASE {key} % 10 {cases} END"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        # The schema is inferred once; every use still reads the table afresh.
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(self.path(name)).schema
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS product_id",
            f"{_category('p_partkey')} AS category",
            "p_brand AS brand",
            "p_name AS title",
            "p_retailprice AS price",
            "p_partkey % 9 <> 0 AS in_stock",
            "CASE WHEN p_partkey % 4 = 0 THEN 'JP' ELSE 'KR' END AS region",
            "p_partkey % 20 <> 0 AS license_ok",
            "CASE WHEN p_partkey % 5 = 0 THEN concat('img/', p_partkey, '.jpg') "
            "ELSE concat('marker://run/', p_partkey) END AS image_path",
        )

    def post_products(self) -> DataFrame:
        return self.raw("lineitem").selectExpr("l_orderkey AS post_id", "l_partkey AS product_id").distinct()

    def detections(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS detection_id",
            "l_orderkey AS post_id",
            f"CASE WHEN (l_orderkey + l_linenumber) % 6 = 0 THEN 'shoes' ELSE {_category('l_partkey')} END AS category",
            "round(0.35D + l_discount * 6, 4) AS score",
            "round(l_quantity / 100D, 4) AS area_frac",
        )

    def posts(self) -> DataFrame:
        """Every order is a post, with or without detections."""
        return self.raw("orders").selectExpr("o_orderkey AS post_id")

    def catalogue(self) -> DataFrame:
        return self.raw("embeddings").selectExpr(
            "vec_id AS product_id",
            f"{_category('vec_id')} AS category",
            "vec_id % 9 <> 0 AS in_stock",
            "CASE WHEN vec_id % 4 = 0 THEN 'JP' ELSE 'KR' END AS region",
            "cast(vec_id % 7 AS double) / 10 AS business_score",
            "label",
            "cast(embedding AS array<double>) AS embedding",
        )

    def _mixed(self, factor: str) -> DataFrame:
        """Catalogue rows with a multiple of another vector added."""
        partners = self.catalogue().select(F.col("product_id").alias("partner"), F.col("embedding").alias("other"))
        a = self.catalogue().withColumn("_n", self.id_count("embeddings", "vec_id"))
        a = a.withColumn("partner", F.expr("(product_id * 37 + 11) % _n"))
        added = F.expr(f"coalesce(zip_with(embedding, other, (x, y) -> x + {factor} * y), embedding)")
        return a.join(partners, "partner", "left").withColumn("embedding", added).drop("partner", "other", "_n")

    def id_count(self, name: str, key: str) -> Column:
        """One more than the largest id of a table, as a scalar subquery."""
        return self.raw(name).agg(F.max(key) + 1).scalar()

    def near_copies(self) -> DataFrame:
        return self._mixed("0.15D").selectExpr("product_id + 1000000 AS product_id", "category", "embedding")

    def queries(self) -> DataFrame:
        """A perturbed copy of every catalogue vector, noisier by tens of ids."""
        area = "cast(product_id % 40 + 1 AS double) / 100"
        return self._mixed("(cast(floor(product_id / 10) AS int) % 5) * 0.6D").selectExpr(
            "product_id AS query_id",
            "category",
            "embedding",
            f"{area} AS area_frac",
            "CASE product_id % 8 WHEN 0 THEN 'styled_post' WHEN 2 THEN 'phone_photo' WHEN 4 THEN 'screenshot' END AS query_condition",
            f"CASE WHEN {area} < 0.08D THEN 'small' WHEN {area} < 0.30D THEN 'medium' ELSE 'large' END AS size_band",
            f"CASE WHEN {area} < 0.05D THEN 'heavy' ELSE 'none' END AS occlusion",
            "label",
        )

    def relevance(self) -> DataFrame:
        """Own product 1.0; a second one at 0.5 for some; queries of label 9 are unjudged."""
        judged = self.catalogue().where("label <> 9")
        own = judged.selectExpr("product_id AS query_id", "product_id", "1.0D AS grade")
        similar = judged.where("label < 3").withColumn("_n", self.id_count("embeddings", "vec_id")).selectExpr(
            "product_id AS query_id", "(product_id + 10) % _n AS product_id", "0.5D AS grade"
        )
        return own.unionByName(similar)

    def events(self) -> DataFrame:
        return self.raw("events").withColumn("_n", self.id_count("part", "p_partkey")).selectExpr(*EVENT_COLUMNS)

    def flagged_events(self) -> DataFrame:
        return monitor.reformulated(self.events())

    def later_clicks(self) -> DataFrame:
        """Clicks that arrive after the search: on the second result, four minutes later."""
        return self.events().where("n_results > 1").selectExpr(
            "event_id", "element_at(results_shown, 2) AS product_id", "event_ts + INTERVAL 4 MINUTES AS click_ts"
        )

    def alias_moves(self) -> DataFrame:
        """The event log read as alias moves of one model per user."""
        return self.raw("events").selectExpr(
            "concat('encoder_', user_id) AS model_name",
            "CASE WHEN event_type = 'purchase' THEN 'production' ELSE 'candidate' END AS alias",
            "cast(event_id AS int) AS version",
            "cast(ts AS timestamp) AS moved_at",
        )

    def promotions(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "cast(ts AS timestamp) AS promoted_at",
            "concat('encoder_', user_id) AS model_name",
            "event_type AS alias",
            "cast(event_id AS int) - 1 AS from_version",
            "cast(event_id AS int) AS to_version",
            "CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value > 100 THEN 'FORCED' ELSE 'PASSED' END AS gate_status",
            "concat('user', user_id) AS promoted_by",
        )

    def index_syncs(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "concat('index_', user_id) AS index_name", "cast(ts AS timestamp) AS synced_at",
            "cast(value AS bigint) AS n_vectors",
        )

    def image_pairs(self) -> DataFrame:
        """Line items as incoming image pairs; a returned item has lost its anchor image."""
        return self.raw("lineitem").selectExpr(
            "concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pair_key",
            "CASE WHEN l_returnflag <> 'R' THEN concat('street/', l_orderkey, '.jpg') END AS street_crop",
            "concat('shop/', l_partkey, '.jpg') AS shop_thumb",
            "cast(l_partkey % 7 AS int) AS class_label",
        )

    def run_products(self) -> DataFrame:
        """Embeddings as the delivery of one run per label."""
        return self.catalogue().selectExpr("concat('run-', label) AS stamp", "product_id", "category", "embedding")

    def run_manifests(self) -> DataFrame:
        """What each delivery claims; every fourth label names another encoder."""
        return self.raw("embeddings").groupBy("label").agg(
            F.count(F.lit(1)).alias("n_products"), F.min(F.size("embedding")).alias("embedding_dim")
        ).selectExpr(
            "concat('run-', label) AS stamp", "n_products", "embedding_dim",
            "CASE WHEN label % 4 = 3 THEN 'encoder-b' ELSE 'encoder-a' END AS encoder_repo",
            "CASE WHEN label % 2 = 0 THEN 'cuda' ELSE 'cpu' END AS device",
        )

    def stored_documents(self) -> DataFrame:
        """Documents embedded so far: some by the current encoder, some by the old one."""
        return self.raw("documents").where("lang <> 'en' OR source < 'src5'").selectExpr(
            "doc_id", "CASE WHEN lang = 'en' THEN 'bow:v1' ELSE 'bow:v2' END AS encoder_uri"
        )


EVENT_COLUMNS = [
    "event_id",
    "cast(ts AS timestamp) AS event_ts",
    "user_id AS session_id",
    "CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('q/', event_id) END AS query_image",
    "CASE event_id % 7 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' WHEN 2 THEN 'outer' WHEN 3 THEN 'dress' "
    "WHEN 4 THEN 'shoes' WHEN 5 THEN 'bag' ELSE 'hat' END AS selected_category",
    "CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version",
    "transform(filter(sequence(0, 11), i -> i < (CASE WHEN event_type = 'error' THEN 0 ELSE 4 + event_id % 9 END)), "
    "i -> cast((event_id * 7 + i * 13) % _n AS bigint)) AS results_shown",
    "CASE WHEN event_type IN ('click', 'purchase') THEN array(cast((event_id * 7 + (event_id % 4) * 13) % _n AS bigint)) "
    "ELSE cast(array() AS array<bigint>) END AS clicked",
    "value * 2 AS latency_ms",
    "cast(CASE WHEN event_type = 'error' THEN 0 ELSE 4 + event_id % 9 END AS int) AS n_results",
    "CASE WHEN ts >= timestamp_ntz'2024-01-24 00:00:00' AND event_id % 2 = 0 THEN 'phone_photo' "
    "WHEN event_id % 3 = 0 THEN 'screenshot' ELSE 'styled_post' END AS query_condition",
]

_AREA = "(product_id % 40 + 1)::DOUBLE / 100"


def _mixed_sql(factor: str) -> str:
    return (
        "SELECT a.* EXCLUDE (embedding), list_transform(list_zip(a.embedding, b.embedding), "
        f"lambda z: z[1] + {factor} * z[2]) AS embedding "
        "FROM f_catalogue a JOIN f_catalogue b ON b.product_id = (a.product_id * 37 + 11) % (SELECT max(vec_id) + 1 FROM embeddings)"
    )


INPUT_SQL = {
    "f_products": f"""
SELECT p_partkey AS product_id, {_category('p_partkey')} AS category, p_brand AS brand, p_name AS title,
       p_retailprice AS price, p_partkey % 9 <> 0 AS in_stock,
       CASE WHEN p_partkey % 4 = 0 THEN 'JP' ELSE 'KR' END AS region, p_partkey % 20 <> 0 AS license_ok,
       CASE WHEN p_partkey % 5 = 0 THEN concat('img/', p_partkey, '.jpg') ELSE concat('marker://run/', p_partkey) END AS image_path
FROM part""",
    "f_post_products": "SELECT DISTINCT l_orderkey AS post_id, l_partkey AS product_id FROM lineitem",
    "f_linked_products": "SELECT l.post_id, p.* FROM f_post_products l JOIN f_products p USING (product_id)",
    "f_detections": f"""
SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS detection_id, l_orderkey AS post_id,
       CASE WHEN (l_orderkey + l_linenumber) % 6 = 0 THEN 'shoes' ELSE {_category('l_partkey')} END AS category,
       round(0.35::DOUBLE + l_discount * 6, 4) AS score, round(l_quantity / 100::DOUBLE, 4) AS area_frac
FROM lineitem""",
    "f_posts": "SELECT o_orderkey AS post_id FROM orders",
    "f_catalogue": f"""
SELECT vec_id AS product_id, {_category('vec_id')} AS category, vec_id % 9 <> 0 AS in_stock,
       CASE WHEN vec_id % 4 = 0 THEN 'JP' ELSE 'KR' END AS region, (vec_id % 7)::DOUBLE / 10 AS business_score,
       label, embedding::DOUBLE[] AS embedding
FROM embeddings""",
    "f_near_copies": f"SELECT product_id + 1000000 AS product_id, category, embedding FROM ({_mixed_sql('0.15::DOUBLE')}) m",
    "f_queries": f"""
SELECT product_id AS query_id, category, embedding, {_AREA} AS area_frac,
       CASE product_id % 8 WHEN 0 THEN 'styled_post' WHEN 2 THEN 'phone_photo' WHEN 4 THEN 'screenshot' END AS query_condition,
       CASE WHEN {_AREA} < 0.08::DOUBLE THEN 'small' WHEN {_AREA} < 0.30::DOUBLE THEN 'medium' ELSE 'large' END AS size_band,
       CASE WHEN {_AREA} < 0.05::DOUBLE THEN 'heavy' ELSE 'none' END AS occlusion, label
FROM ({_mixed_sql('(floor(a.product_id / 10)::INT % 5) * 0.6::DOUBLE')}) m""",
    "f_relevance": """
SELECT product_id AS query_id, product_id, 1.0::DOUBLE AS grade FROM f_catalogue WHERE label <> 9
UNION ALL
SELECT product_id, (product_id + 10) % (SELECT max(vec_id) + 1 FROM embeddings), 0.5::DOUBLE FROM f_catalogue WHERE label < 3""",
    "f_events": """
SELECT event_id, ts AS event_ts, user_id AS session_id,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('q/', event_id) END AS query_image,
       CASE event_id % 7 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' WHEN 2 THEN 'outer' WHEN 3 THEN 'dress'
            WHEN 4 THEN 'shoes' WHEN 5 THEN 'bag' ELSE 'hat' END AS selected_category,
       CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
       list_transform(range(CASE WHEN event_type = 'error' THEN 0 ELSE 4 + event_id % 9 END), lambda i: (event_id * 7 + i * 13) % _n) AS results_shown,
       CASE WHEN event_type IN ('click', 'purchase') THEN [(event_id * 7 + (event_id % 4) * 13) % _n] ELSE []::BIGINT[] END AS clicked,
       value * 2 AS latency_ms, (CASE WHEN event_type = 'error' THEN 0 ELSE 4 + event_id % 9 END)::INT AS n_results,
       CASE WHEN ts >= TIMESTAMP '2024-01-24 00:00:00' AND event_id % 2 = 0 THEN 'phone_photo'
            WHEN event_id % 3 = 0 THEN 'screenshot' ELSE 'styled_post' END AS query_condition
FROM events, (SELECT max(p_partkey) + 1 AS _n FROM part)""",
    "f_flagged_events": """
SELECT *, coalesce(epoch_us(lead(event_ts) OVER (PARTITION BY session_id ORDER BY event_ts, event_id)) - epoch_us(event_ts) <= 600000000, false) AS reformulated
FROM f_events""",
    "f_later_clicks": """
SELECT event_id, results_shown[2] AS product_id, event_ts + INTERVAL 4 MINUTE AS click_ts FROM f_events WHERE n_results > 1""",
    "f_alias_moves": """
SELECT concat('encoder_', user_id) AS model_name, CASE WHEN event_type = 'purchase' THEN 'production' ELSE 'candidate' END AS alias,
       event_id::INT AS version, ts AS moved_at
FROM events""",
    "f_promotions": """
SELECT ts AS promoted_at, concat('encoder_', user_id) AS model_name, event_type AS alias, event_id::INT - 1 AS from_version,
       event_id::INT AS to_version,
       CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value > 100 THEN 'FORCED' ELSE 'PASSED' END AS gate_status,
       concat('user', user_id) AS promoted_by
FROM events""",
    "f_index_syncs": "SELECT concat('index_', user_id) AS index_name, ts AS synced_at FROM events",
    "f_image_pairs": """
SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pair_key,
       CASE WHEN l_returnflag <> 'R' THEN concat('street/', l_orderkey, '.jpg') END AS street_crop,
       concat('shop/', l_partkey, '.jpg') AS shop_thumb, (l_partkey % 7)::INT AS class_label
FROM lineitem""",
    "f_run_products": "SELECT concat('run-', label) AS stamp, product_id, category, embedding FROM f_catalogue",
    "f_run_manifests": """
SELECT concat('run-', label) AS stamp, count(*) AS n_products, min(len(embedding)) AS embedding_dim,
       CASE WHEN label % 4 = 3 THEN 'encoder-b' ELSE 'encoder-a' END AS encoder_repo,
       CASE WHEN label % 2 = 0 THEN 'cuda' ELSE 'cpu' END AS device
FROM embeddings GROUP BY label""",
    "f_stored_documents": """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'bow:v1' ELSE 'bow:v2' END AS encoder_uri
FROM documents WHERE lang <> 'en' OR source < 'src5'""",
}

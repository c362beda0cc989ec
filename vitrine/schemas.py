"""Declared schemas of the stored tables, as DDL; writes are checked against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_K_VALUES = (1, 5, 10, 20, 50)


PRODUCTS = (
    "product_id string, image_path string, category string, brand string, title string, "
    "price double, currency string, in_stock boolean, region string, source string, "
    "license_ok boolean, ingested_at timestamp, updated_at timestamp"
)
POSTS = (
    "post_id string, image_path string, linked_products array<string>, source string, "
    "captured_at timestamp, license_ok boolean, ingested_at timestamp"
)
SEARCH_EVENTS = (
    "event_id string, event_ts timestamp, session_id string, query_image string, "
    "selected_category string, selected_box struct<x1:double,y1:double,x2:double,y2:double>, "
    "model_version string, index_version string, results_shown array<string>, "
    "clicked array<string>, added_to_cart array<string>, latency_ms double, n_results int, "
    "reformulated boolean, query_condition string, fallback_fired boolean"
)
DETECTIONS = (
    "detection_id string, post_id string, category string, score double, x1 double, y1 double, "
    "x2 double, y2 double, area_frac double, crop_path string, detected_at timestamp"
)
PRODUCT_EMBEDDINGS = (
    "product_id string, embedding array<float>, category string, in_stock boolean, region string, "
    "brand string, price double, embedded_at timestamp, encoder_alias string, encoder_uri string"
)
QUERY_EMBEDDINGS = (
    "post_id string, embedding array<float>, size_band string, occlusion string, encoder_uri string"
)
TRAIN_PAIRS = (
    "pair_id string, product_id string, post_id string, anchor_path string, positive_path string, "
    "category string, score double, area_frac double, split string, built_at timestamp"
)
EVAL_QUERIES = (
    "post_id string, query_image string, category string, relevant_ids array<string>, "
    "relevance_map map<string,double>, query_condition string, size_band string, "
    "occlusion string, frozen_at timestamp"
)
RETRIEVAL_METRICS = (
    "slice_dim string, slice_value string, n_queries bigint, "
    + ", ".join(f"recall_at_{k} double" for k in _K_VALUES)
    + ", "
    + ", ".join(f"ndcg_at_{k} double" for k in _K_VALUES)
    + ", mrr double, model_name string, model_version string, evaluated_at timestamp, gate_passed boolean"
)
ALERTS = "payload string, kind string, severity string, raised_at timestamp"
INDEX_SYNCS = "index_name string, synced_at timestamp, n_vectors bigint"
DRIFT_SNAPSHOTS = "captured_at timestamp, model_version string, payload string"
PROMOTIONS = (
    "promoted_at timestamp, model_name string, alias string, from_version int, to_version int, "
    "gate_status string, promoted_by string"
)
SERVING_CHECKS = (
    "checked_at timestamp, model_version string, p50_ms double, p95_ms double, budget_ms double, "
    "within_budget boolean"
)
ALIAS_MOVES = "model_name string, alias string, version int, moved_at timestamp"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast the declared columns; a missing column is an error."""
    schema = StructType.fromDDL(ddl)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

"""Keys, nulls and lengths that used to give wrong results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import losses, monitor, retrieve, skew


def vectors(n, dim=4):
    return [[float((i * 7 + d * 3) % 5 + 1) for d in range(dim)] for i in range(n)]


def test_image_ids_may_contain_the_separator(spark):
    catalogue = spark.createDataFrame([(i, "bag", v) for i, v in enumerate(vectors(5))], "product_id long, category string, embedding array<double>")
    items = [("a#8", 0, "bag"), ("a#9", 0, "bag"), ("a", 8, "bag"), ("#", 1, "bag")]
    found = retrieve.multi_item_search(
        spark.createDataFrame([(*x, [1.0, 2.0, 3.0, 4.0]) for x in items], "image_id string, item_index int, category string, embedding array<double>"), catalogue, k=2
    )
    assert {(r["image_id"], r["item_index"]) for r in found.collect()} == {x[:2] for x in items}


def test_a_category_spelled_like_the_open_scope(spark):
    catalogue = spark.createDataFrame([(1, "*", [1.0, 0.0]), (2, "bag", [0.0, 1.0])], "product_id long, category string, embedding array<double>")
    items = spark.createDataFrame([("i", 0, "*", [1.0, 0.0]), ("i", 1, "unknown", [1.0, 0.0])], "image_id string, item_index int, category string, embedding array<double>")
    got = sorted((r["item_index"], r["product_id"]) for r in retrieve.multi_item_search(items, catalogue, k=5).collect())
    assert got == [(0, 1), (1, 1), (1, 2)]


def test_anchors_with_different_numbers_of_negatives(spark):
    rng = np.random.default_rng(0)
    rows = [(n, *(rng.normal(size=(2, 3)).tolist()), rng.normal(size=(n, 3)).tolist() if n else None) for n in (1, 3, 0)]
    table = spark.createDataFrame(rows, "pair_id int, anchor array<double>, positive array<double>, negatives array<array<double>>")
    got = losses.batch_losses(table, losses.hard_negative_nce(0.1), 1, "negatives").first()["loss"]
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    want = []
    for k, a, p, negatives in rows:
        scores = [unit(a) @ unit(r[2]) / 0.1 for r in rows] + [unit(a) @ unit(x) / 0.1 for x in negatives or []]
        want.append(np.log(np.exp(scores).sum()) - unit(a) @ unit(p) / 0.1)
    assert got == pytest.approx(np.mean(want))


def test_ranks_keep_rows_with_null_keys_and_buckets(spark):
    rows = [("a", 3.0), ("a", None), ("a", 1.0), (None, 2.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ranked = skew.rank_in_groups(df, ["g"], F.floor("v"), [F.col("v")])
    got = {}
    for r in ranked.collect():
        got.setdefault(r["g"], []).append((r["rank"], r["v"]))
    assert sorted(got["a"]) == [(1, None), (2, 1.0), (3, 3.0)]
    assert sorted(got[None]) == [(1, None), (2, 2.0)]


def test_a_search_without_session_is_never_reformulated(spark):
    events = spark.sql("""SELECT id AS event_id, s AS session_id, timestamp_seconds(t) AS event_ts FROM VALUES
        (1, NULL, 590), (2, NULL, 610), (3, NULL, 620), (4, 'x', 590), (5, 'x', 610) AS v(id, s, t)""")
    assert {r["event_id"] for r in monitor.reformulated(events).where("reformulated").collect()} == {4}


def test_an_index_that_never_synced_is_reported(spark):
    log = spark.sql("SELECT 'one' AS index_name, timestamp'2024-01-30 00:00:00' AS synced_at")
    expected = spark.sql("SELECT * FROM VALUES ('one'), ('two') AS t(index_name)")
    got = {r["index_name"]: r["kind"] for r in monitor.freshness(log, "2024-01-31", "synced_at", ["index_name"], expected=expected).collect()}
    assert got == {"one": "index_stale", "two": "no_index"}
    none = monitor.freshness(log.where("false"), "2024-01-31", "synced_at", ["index_name"], expected=expected).collect()
    assert [(r["kind"], r["severity"]) for r in none] == [("no_index", "high")] * 2


def test_p95_is_exact_by_group(spark):
    events = spark.range(40_000).selectExpr(
        "id AS event_id", "timestamp'2024-01-31 01:00:00' AS event_ts", "array(id) AS clicked", "1 AS n_results", "false AS reformulated",
        "cast(id AS double) / 7 AS latency_ms", "IF(id % 4 = 0, NULL, 'v') AS model_version",
    )
    got = {r["model_version"]: r["p95_latency"] for r in monitor.online_metrics(events, "2024-01-31", by=["model_version"]).collect()}
    for version, ids in ((None, [i for i in range(40_000) if i % 4 == 0]), ("v", [i for i in range(40_000) if i % 4])):
        assert got[version] == ids[-(-len(ids) * 95 // 100) - 1] / 7


def test_the_day_filter_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr(
        "id AS event_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id AS int)) AS event_ts", "'s' AS session_id",
        "array(id) AS clicked", "1 AS n_results", "cast(id AS double) AS latency_ms",
    ).write.parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    plan = monitor.online_metrics(monitor.reformulated(monitor.since(events, "2024-01-31", 1)), "2024-01-31")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_ts" in text

"""The inverted-file index beside exact search."""

import numpy as np
from pyspark.sql import functions as F

from vitrine.operators import ivf, retrieve
from vitrine.session import work_dir

DIM = 8


def frame(spark, rows, id_name):
    return spark.createDataFrame(rows, f"{id_name} long, category string, embedding array<double>")


def clustered(n, seed, first=0):
    rng = np.random.RandomState(seed)
    centres = np.random.RandomState(99).standard_normal((6, DIM))
    keys = np.where(rng.rand(n) < 0.7, "hot", rng.choice(["a", "b"], n))
    return [(first + i, str(keys[i]), [float(x) for x in centres[i % 6] + 0.2 * rng.standard_normal(DIM)]) for i in range(n)]


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["product_id"], r["score"]))
    return out


def test_every_list_probed_equals_exact_search(spark):
    products = clustered(300, 1) + [(900, "hot", [0.0] * DIM), (901, "hot", None), (902, "lonely", [1.0] * DIM)]
    asked = clustered(40, 2) + [(50, "unknown", [1.0] * DIM), (51, "hot", None), (52, "hot", [0.0] * DIM), (53, "lonely", [-1.0] + [1.0] * (DIM - 1))]
    catalogue, queries = frame(spark, products, "product_id"), frame(spark, asked, "query_id")
    path = work_dir(spark, "test-index")
    ivf.build(catalogue, path, DIM, rows_per_list=20)
    got = lists(ivf.search(queries, path, 7, probes=1000, recall_k=1000))
    want = lists(retrieve.exact_topk(queries, catalogue, 7))
    assert {q: [p for p, _ in v] for q, v in got.items()} == {q: [p for p, _ in v] for q, v in want.items()}
    assert 52 not in got and 50 not in got and [p for p, _ in got[53]] == [902]


def test_few_probes_find_most_and_every_row_is_indexed(spark):
    catalogue, queries = frame(spark, clustered(400, 3), "product_id"), frame(spark, clustered(50, 4), "query_id")
    path = work_dir(spark, "test-index")
    centroids = ivf.build(catalogue, path, DIM, rows_per_list=25, sample=0.5)
    assert ivf.lists_of(spark, path).count() == 400
    found = retrieve.recall_against(retrieve.exact_topk(queries, catalogue, 10), ivf.search(queries, path, 10, probes=5, recall_k=60))
    assert found.first()["recall"] >= 0.9
    assert centroids.groupBy("category").count().where("category = 'hot'").first()["count"] > 5


def test_rebuilding_gives_the_same_index(spark):
    catalogue = frame(spark, clustered(200, 5), "product_id")
    indexes = []
    for parts in (1, 7):
        path = work_dir(spark, "test-index")
        ivf.build(catalogue.repartition(parts), path, DIM, rows_per_list=20)
        indexes.append(sorted(tuple(r) for r in ivf.lists_of(spark, path).select("product_id", "list", F.col("code").cast("string")).collect()))
    assert indexes[0] == indexes[1]


def test_lists_are_pruned_at_the_scan(spark):
    catalogue, queries = frame(spark, clustered(300, 6), "product_id"), frame(spark, clustered(5, 7), "query_id")
    path = work_dir(spark, "test-index")
    ivf.build(catalogue, path, DIM, rows_per_list=20)
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    try:
        plan = ivf.search(queries, path, 3, probes=2)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly")
    assert "dynamicpruning" in plan


def test_survivors_are_rescored_without_a_join(spark):
    catalogue = frame(spark, clustered(120, 8), "product_id").withColumn("in_stock", F.lit(True))
    queries = frame(spark, clustered(20, 9), "query_id")
    for found in (retrieve.two_stage_search(queries, catalogue, 20, 4, 5), retrieve.binary_rerank(queries, catalogue, DIM, 20, 5)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan.split("FlatMapCoGroupsInArrow")[0]
    wide = lists(retrieve.two_stage_search(queries, catalogue, 500, 4, 5, business_weight=0.0))
    exact = lists(retrieve.exact_topk(queries, catalogue, 5))
    assert {q: [p for p, _ in v] for q, v in wide.items()} == {q: [p for p, _ in v] for q, v in exact.items()}


def test_a_share_of_lists_is_asked_without_listing_them(spark, monkeypatch):
    catalogue, queries = frame(spark, clustered(300, 10), "product_id"), frame(spark, clustered(40, 11) + [(50, "unknown", [1.0] * DIM)], "query_id")
    path = work_dir(spark, "test-index")
    centroids = ivf.build(catalogue, path, DIM, rows_per_list=10)
    asked = queries.withColumn("q", ivf.integer_unit())
    of = {}
    for r in centroids.collect():
        of.setdefault(r["category"], []).append((r["list"], np.array(r["centroid"], dtype=np.int64)))
    members = {}
    for r in ivf.lists_of(spark, path).collect():
        members.setdefault(r["list"], []).append((r["product_id"], np.array(r["code"], dtype=np.int64), np.array(r["embedding"])))
    want = {}
    for r in asked.where("category <> 'unknown'").collect():
        q, v = np.array(r["q"], dtype=np.int64), np.array(r["embedding"])
        ranked = sorted(of[r["category"]], key=lambda x: (x[1] @ x[1] - 2 * (q @ x[1]), x[0]))[: int(np.ceil(len(of[r["category"]]) * 0.5))]
        coded = sorted((-(q @ (c + code * ivf.STEP + ivf.STEP // 2)), p, -round(v @ e / np.sqrt((v @ v) * (e @ e)), 12)) for n, c in ranked for p, code, e in members[n])
        want[r["query_id"]] = [p for _, p in sorted((s, p) for _, p, s in coded[:15])][:5]
    monkeypatch.setattr(ivf, "nearest_lists", None)  # a row per query and list is what this search does without
    for blocks in (8_192, 16):
        monkeypatch.setattr(ivf, "QUERY_BLOCK", blocks)
        monkeypatch.setattr(ivf, "CATALOGUE_BLOCK", blocks)
        got = lists(ivf.search(queries, path, 5, probes=0.5, recall_k=15))
        assert {q: [p for p, _ in found] for q, found in got.items()} == want
    assert ivf.last_probed(asked, spark.read.parquet(f"{path}/centroids"), 0.5).count() == 40

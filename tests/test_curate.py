import random

import pytest
from pyspark.sql import Window, functions as F

from vitrine.functions.scalars import detection_id, occlusion, size_band
from vitrine.operators import curate


@pytest.fixture
def market(spark):
    """Detections, links and products with one post holding most rows."""
    rng = random.Random(8)
    post = lambda: 1 if rng.random() < 0.5 else rng.randint(2, 80)
    cats = ["bag", "hat", "top", "shoes", "dress"]
    detections = [(f"d{i}", post(), rng.choice(cats), rng.choice([0.4, 0.45, 0.9]), rng.random(), f"crop/{i}") for i in range(400)]
    links = list({(post(), rng.randint(0, 40)) for _ in range(300)})
    products = [(p, rng.choice(cats), f"img/{p}", rng.choice([True, True, False, None])) for p in range(40)]
    return (
        spark.createDataFrame(detections, "detection_id string, post_id int, category string, score double, area_frac double, crop_path string"),
        spark.createDataFrame(links, "post_id int, product_id int"),
        spark.createDataFrame(products, "product_id int, category string, image_path string, license_ok boolean"),
    )


def joined(detections, links, products):
    """The plain definition: join everything, then count each (post, category)."""
    return (
        detections.where("score >= 0.45").join(links, "post_id")
        .join(products.where("license_ok").withColumnRenamed("category", "pc"), "product_id").where("category = pc")
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("post_id", "category")))
    )


def test_pairs_equal_the_plain_definition(market, rows):
    columns = ["pair_id", "product_id", "post_id", "anchor_path", "positive_path", "category", "score", "area_frac"]
    expected = joined(*market).where("n = 1").withColumnsRenamed({"detection_id": "pair_id", "crop_path": "anchor_path", "image_path": "positive_path"})
    got = curate.build_pairs(*market)
    assert got.columns == columns
    assert rows(got) == rows(expected.select(*columns)) and got.count() > 10


def test_ambiguous_groups_equal_the_plain_definition(market, rows):
    expected = joined(*market).where("n > 1").select("post_id", "category", "n").distinct()
    assert rows(curate.ambiguous_groups(*market)) == rows(expected)


def test_pairs_are_counted_without_multiplying_a_crowded_post(market):
    plan = curate.build_pairs(*market)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") >= 2


def test_split_is_by_product_and_repeatable(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("product_id"), "id")
    for mode in ("murmur", "md5"):
        split = curate.split_by_key(df, fraction=0.08, mode=mode)
        train, held = split.where("split = 'train'"), split.where("split = 'eval'")
        curate.assert_no_leakage(train, held)
        assert 0.02 < held.select("product_id").distinct().count() / 700 < 0.15
    by_row = curate.split_by_key(df, key="id", fraction=0.5)
    with pytest.raises(ValueError, match="both sides"):
        curate.assert_no_leakage(by_row.where("split = 'train'"), by_row.where("split = 'eval'"))


def test_split_does_not_depend_on_the_key_type(spark):
    df = spark.range(200)
    as_int = curate.split_by_key(df.select(F.col("id").cast("int").alias("k")), "k", 0.3)
    as_text = curate.split_by_key(df.select(F.col("id").cast("string").alias("k")), "k", 0.3)
    assert [r[1] for r in as_int.collect()] == [r[1] for r in as_text.collect()]


@pytest.mark.parametrize("wanted, products, cut", [(500, 2000, 250), (10, 2000, 50), (500, 0, 500_000)])
def test_eval_cut(wanted, products, cut):
    assert curate.eval_cut(wanted, products) == cut


def test_eval_set_and_nesting(spark):
    links = spark.createDataFrame([(1, 10), (1, 11), (1, 10), (2, 10), (2, 99)], "post_id int, product_id int")
    products = spark.createDataFrame([(10, "bag"), (11, "bag")], "product_id int, category string")
    judgments = curate.prepare_eval_set(links, products, 1000)
    nested = {r["post_id"]: r for r in curate.nest_judgments(judgments, ["post_id", "category"]).collect()}
    assert nested[1]["relevant_ids"] == [10, 11] and nested[1]["relevance_map"] == {10: 1.0, 11: 1.0}
    assert nested[2]["relevant_ids"] == [10]
    assert judgments.select("grade", "query_condition", "size_band", "occlusion").distinct().collect()[0] == (1.0, "styled_post", "unknown", "unknown")


def test_slice_coverage(spark):
    queries = spark.createDataFrame([("bag",)] * 30 + [("hat",)] * 3 + [("top",)] * 67, "category string")
    got = {r["slice_value"]: r for r in curate.slice_coverage(queries, [("category", "bag"), ("category", "hat"), ("category", "scarf"), ("size_band", "small")], 20).collect()}
    assert (got["bag"]["status"], got["bag"]["needed"]) == ("OK", None)
    assert (got["hat"]["status"], got["hat"]["needed"]) == ("TOO FEW", int(20 / 0.03 * 1.15))
    assert (got["scarf"]["n_queries"], got["scarf"]["share"], got["scarf"]["needed"]) == (0, 0.0, None)
    assert "small" not in got


def test_labels(spark):
    df = spark.createDataFrame([(v,) for v in (0.049, 0.05, 0.079, 0.08, 0.299, 0.30)], "a double")
    got = df.select(size_band("a"), occlusion("a")).collect()
    assert [r[0] for r in got] == ["small", "small", "small", "medium", "medium", "large"]
    assert [r[1] for r in got] == ["heavy"] + ["none"] * 5


def test_fold_labels_keeps_unmatched(spark):
    queries = spark.createDataFrame([(1, "unknown", "unknown"), (2, "unknown", "unknown")], "post_id int, size_band string, occlusion string")
    labels = spark.createDataFrame([(1, "small", "heavy")], "post_id int, size_band string, occlusion string")
    assert {tuple(r) for r in curate.fold_slice_labels(queries, labels).collect()} == {(1, "small", "heavy"), (2, "unknown", "unknown")}


EVENTS = "event_id int, event_ts timestamp, query_image string, selected_category string, results_shown array<int>, clicked array<int>"


def events(spark, data):
    return spark.createDataFrame(data, "event_id int, at string, query_image string, selected_category string, results_shown array<int>, clicked array<int>").withColumn(
        "event_ts", F.col("at").cast("timestamp")
    )


def test_click_feedback(spark):
    log = events(spark, [
        (1, "2024-01-30 10:00:00", "q/1", "bag", [5, 6, 7, 8, 9, 10], [6]),
        (2, "2024-01-29 10:00:00", None, "bag", [5, 6], [5]),
        (3, "2023-12-01 10:00:00", "q/3", "bag", [5, 6], [5]),
        (4, "2024-01-28 10:00:00", "q/4", "hat", [5, 6], []),
        (5, "2024-01-27 10:00:00", "q/5", "hat", [5, 6], [6, 404]),
    ])
    products = spark.createDataFrame([(5, "img/5"), (6, "img/6")], "product_id int, image_path string")
    pairs = curate.click_pairs(log, products, "2024-01-31")
    assert [tuple(r) for r in pairs.collect()] == [
        ("click_1_6", 6, 1, "q/1", "img/6", "bag", 1.0, 0.0), ("click_5_6", 6, 5, "q/5", "img/6", "hat", 1.0, 0.0)]
    assert [r["pair_id"] for r in curate.click_pairs(log, products, "2024-01-31", max_pairs=1).collect()] == ["click_1_6"]
    negatives = {(r["event_id"], r["negative_product_id"], r["shown_rank"]) for r in curate.hard_negatives(log, "2024-01-31").collect()}
    assert negatives == {(1, 5, 0), (1, 7, 2), (1, 8, 3), (1, 9, 4), (5, 5, 0)}


def test_sample_is_repeatable_on_any_partitioning(spark):
    df = spark.range(300).withColumn("category", F.lit("bag"))
    once = [r["id"] for r in curate.sample_rows(df, "id", 20).collect()]
    assert once == [r["id"] for r in curate.sample_rows(df.repartition(17), "id", 20).collect()]
    assert once != [r["id"] for r in curate.sample_rows(df, "id", 20, seed=43).collect()]


def test_detection_id_is_stable(spark):
    import hashlib

    got = spark.createDataFrame([("post", 3, 10.04, 20.26)], "p string, l int, x double, y double").select(detection_id("p", "l", "x", "y")).first()[0]
    assert got == hashlib.sha256(b"post|3|10.0|20.3").hexdigest()[:24]

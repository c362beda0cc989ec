import numpy as np
import pandas as pd
import pytest

from vitrine.operators import infer
from vitrine.plans import inference
from vitrine.plans.inputs import Inputs
from vitrine.plans.models import text_encoder


def encode(items, existing, uri="bow:v1"):
    return infer.embed_incremental(items, existing, text_encoder, uri, "doc_id", ["text"])


@pytest.fixture
def documents(spark):
    return spark.createDataFrame([(n, f"red shoe number {n}") for n in range(30)] + [(30, ""), (31, None)], "doc_id int, text string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id int, embedding array<double>, encoder_uri string")


def test_rerun_adds_nothing_and_unreadable_items_are_left_out(spark, documents, nothing):
    first = spark.createDataFrame(encode(documents, nothing).collect(), nothing.schema)
    assert first.count() == 30
    assert infer.embedding_contract(first, 64, 1e-3).first()["passed"]
    assert encode(documents, first).count() == 0
    more = documents.union(spark.createDataFrame([(99, "hat")], "doc_id int, text string"))
    assert [r["doc_id"] for r in encode(more, first).collect()] == [99]


def test_new_encoder_replaces_vectors(spark, documents, nothing):
    first = spark.createDataFrame(encode(documents, nothing).collect(), nothing.schema)
    fresh = encode(documents.where("doc_id < 10"), first, "bow:v2")
    merged = infer.merge_embeddings(first, spark.createDataFrame(fresh.collect(), nothing.schema), "doc_id")
    counts = {r["encoder_uri"]: r["count"] for r in merged.groupBy("encoder_uri").count().collect()}
    assert counts == {"bow:v1": 20, "bow:v2": 10}


def test_whole_text_counts():
    long_text = " ".join(["a"] * 5000 + ["b"])
    short = next(text_encoder([pd.DataFrame({"doc_id": [1], "text": ["a"]})]))["embedding"][0]
    whole = next(text_encoder([pd.DataFrame({"doc_id": [1], "text": [long_text]})]))["embedding"][0]
    assert (whole != short).any()


LABELS = np.array(["bag", "bottom", "dress", "hat", "outer", "shoes", "top"], dtype=object)
SIDE = 200


def detector():
    """Made inside a function, so that it travels by value."""
    def box_detector(batches: object) -> object:
        """``post_id, o_custkey`` to zero to three boxes on a 200 x 200 image."""
        for batch in batches:
            post = batch["post_id"].to_numpy()
            rows = np.repeat(np.arange(len(batch)), post % 4)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(post % 4) - post % 4, post % 4)
            post, cust = post[rows], batch["o_custkey"].to_numpy()[rows]
            x1, y1 = (cust * 7 + nth * 13) % 100, (post * 3 + nth * 5) % 100
            w, h = 10 + post % 90, 10 + cust % 80
            label = (post + nth) % len(LABELS)
            yield pd.DataFrame({
                "post_id": post, "label": label.astype("int32"), "category": LABELS[label],
                "score": ((post + nth * 17) % 100) / 100.0,
                "x1": x1 * 1.0, "y1": y1 * 1.0, "x2": (x1 + w) * 1.0, "y2": (y1 + h) * 1.0,
                "area_frac": w * h / float(SIDE * SIDE),
            })

    return box_detector


BOXES = "detection_id string, post_id int, category string, score double, area_frac double"


def test_expand_items(spark):
    boxes = spark.createDataFrame(
        [("d1", 1, "hat", 0.9, 0.1), ("d2", 1, "top", 0.5, 0.9), ("d3", 1, "bag", 0.9, 0.5), ("d4", 1, "bag", 0.5, 0.9)], BOXES
    )
    posts = spark.createDataFrame([(1,), (2,)], "post_id int")
    got = sorted((r["post_id"], r["item_index"], r["category"], r["score"], r["area_frac"], r["used_whole_image"]) for r in infer.expand_items(posts, boxes).collect())
    # d2, d3 and d4 tie at 0.45; the lower id comes first.
    assert got == [
        (1, 0, "top", 0.5, 0.9, False), (1, 1, "bag", 0.9, 0.5, False), (1, 2, "bag", 0.5, 0.9, False),
        (1, 3, "hat", 0.9, 0.1, False), (2, 0, None, 0.0, 1.0, True),
    ]
    rate = infer.fallback_rate(infer.expand_items(posts, boxes)).first()
    assert (rate["n_images"], rate["fallback_rate"]) == (2, 0.5)
    assert infer.fallback_rate(infer.first_items(posts, boxes)).first() == rate


def test_best_box_is_item_zero(spark):
    boxes = spark.createDataFrame([(f"d{n}", n % 7, "bag", (n * 13 % 10) / 10, (n * 7 % 9) / 9) for n in range(60)], BOXES)
    posts = boxes.select("post_id").distinct()
    best = {(r["post_id"], r["score"], r["area_frac"]) for r in infer.best_box(boxes).collect()}
    first = {(r["post_id"], r["score"], r["area_frac"]) for r in infer.expand_items(posts, boxes).where("item_index = 0").collect()}
    assert best == first


def test_detections_are_filtered_and_repeatable(spark):
    images = spark.range(200).selectExpr("id AS post_id", "id * 3 AS o_custkey")
    once = infer.detect_items(images, detector(), ["o_custkey"]).collect()
    again = infer.detect_items(images.repartition(7), detector(), ["o_custkey"]).collect()
    assert {r["detection_id"] for r in once} == {r["detection_id"] for r in again}
    assert all(r["score"] >= 0.40 and r["area_frac"] >= 0.008 for r in once) and len(once) > 50


def test_contract_finds_violations(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [2.0, 0.0]), (4, None)], "g int, embedding array<double>")
    r = infer.embedding_contract(vectors, 2).first()
    assert (r["n_vectors"], r["wrong_dimension"], r["wrong_norm"], r["passed"]) == (4, 2, 2, False)


def test_delivered_boxes(spark):
    rows = [
        (1, 2, "bag", 0.5, 10.0, 10.0, 30.0, 60.0), (1, 2, "bag", None, 10.0, 10.0, 30.0, 60.0), (2, 0, "hat", 0.4, 0.0, 0.0, 8.0, 10.0),
        (3, 0, "hat", 0.39, 0.0, 0.0, 80.0, 10.0), (4, 0, "hat", 0.9, 5.0, 5.0, 5.0, 90.0), (5, 1, None, 0.9, 50.0, 50.0, 10.0, 10.0),
    ]
    boxes = spark.createDataFrame(rows, "post_id int, label int, category string, score double, x1 double, y1 double, x2 double, y2 double")
    kept = infer.keep_boxes(boxes, 100.0, 100.0).collect()
    assert [(r["post_id"], r["area_frac"]) for r in kept if r["post_id"] != 2] == [(1, 0.1)]
    assert [r["area_frac"] for r in kept if r["post_id"] == 2] == [0.008]
    assert infer.keep_boxes(boxes, 100.0, 100.0).select("detection_id").distinct().count() == 2


def test_detect_job_runs_the_detector_over_every_image(spark, tmp_path):
    rows = [(n, n * 3) for n in range(1, 400)] + [(None, 5), (7, None), (-3, 8), (403, -9)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    found = inference.detect_job(Inputs(spark, str(tmp_path))).collect()
    want = [
        (post, ((cust * 7 + k * 13) % 100) * 1.0, ((post * 3 + k * 5) % 100) * 1.0)
        for post, cust in rows if post and cust and post > 0 and cust > 0 for k in range(post % 4)
        if (post + k * 17) % 100 >= 40 and (10 + post % 90) * (10 + cust % 80) >= 320
    ]
    assert sorted((r["post_id"], r["x1"], r["y1"]) for r in found if r["post_id"] != 403) == sorted(want)

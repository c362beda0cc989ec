import math

import pytest
from pyspark.sql import functions as F

from vitrine.operators import metrics

RANKED = "query_id string, rank int, product_id string"
JUDGED = "query_id string, product_id string, grade double"


def measure(spark, ranked, grades, k_values=(1, 2, 3, 5)):
    """Metrics of one query from a ranked list and a grade per relevant id."""
    queries = spark.createDataFrame([("q",)], "query_id string")
    results = spark.createDataFrame([("q", n, p) for n, p in enumerate(ranked, 1)], RANKED)
    judged = spark.createDataFrame([("q", p, g) for p, g in grades.items()], JUDGED)
    return metrics.query_metrics(queries, results, judged, k_values).first()


SHELF = ["p3", "p8", "p1", "p9", "p4"]  # the ranking that the cases below are judged against


def by_hand(grades, k):
    """Recall, NDCG and reciprocal rank of SHELF, from their definitions."""
    good = {p for p, g in grades.items() if g > 0}
    if not good:
        return None, None, None
    dcg = sum(grades.get(p, 0.0) / math.log2(n + 1) for n, p in enumerate(SHELF[:k], 1))
    ideal = sum(g / math.log2(n + 1) for n, g in enumerate(sorted(grades.values(), reverse=True)[:k], 1))
    first = next((1 / n for n, p in enumerate(SHELF, 1) if p in good), 0.0)
    return len(good & set(SHELF[:k])) / len(good), dcg / ideal, first


@pytest.mark.parametrize("k", [1, 2, 3, 5])
@pytest.mark.parametrize(
    "grades",
    [{"p9": 1.0}, {"p8": 0.5, "p4": 1.0, "p0": 1.0}, {"p0": 1.0, "p7": 0.5}, {"p3": 1.0, "p8": 1.0, "p1": 0.5, "p9": 0.5}, {"p3": 0.25}],
)
def test_against_the_definitions(spark, grades, k):
    row, (recall, ndcg, reciprocal) = measure(spark, SHELF, grades), by_hand(grades, k)
    assert row[f"recall_at_{k}"] == pytest.approx(recall)
    assert row[f"ndcg_at_{k}"] == pytest.approx(ndcg)
    assert row["mrr"] == pytest.approx(reciprocal)


def test_unjudged_and_worthless_queries_have_no_measure(spark):
    for grades in ({}, {"p3": 0.0, "p1": 0.0}):
        row = measure(spark, SHELF, grades)
        assert row["ndcg_at_5"] is None


def test_an_empty_ranking_finds_nothing(spark):
    row = measure(spark, [], {"p1": 1.0, "p2": 0.5})
    assert (row["recall_at_5"], row["mrr"]) == (0.0, 0.0)


def test_repeated_judgments_count_once(spark):
    queries = spark.createDataFrame([("q",)], "query_id string")
    results = spark.createDataFrame([("q", 1, "a")], RANKED)
    judged = spark.createDataFrame([("q", "a", 1.0), ("q", "a", 0.5), ("q", "b", 1.0)], JUDGED)
    assert metrics.query_metrics(queries, results, judged, (1,)).first()["recall_at_1"] == 0.5


def test_slices_skip_missing_values_and_null_keys(spark):
    schema = "query_id int, category string, query_condition string, size_band string, occlusion string, recall_at_1 double, ndcg_at_1 double, mrr double"
    per_query = spark.createDataFrame(
        [(1, "bag", None, "small", "none", 1.0, 1.0, 1.0), (2, "bag", "photo", "small", "none", None, None, 0.0), (3, "hat", "photo", "large", "none", 0.0, 0.0, 0.0)],
        schema,
    )
    got = {(r["slice_dim"], r["slice_value"]): r for r in metrics.slice_metrics(per_query, k_values=(1,)).collect()}
    assert got["category", "bag"]["recall_at_1"] == 1.0
    assert got["category", "bag"]["mrr"] == 0.5
    assert got["category", "bag"]["n_queries"] == 2
    assert got["overall", "all"]["n_queries"] == 3
    assert got["overall", "all"]["recall_at_1"] == 0.5
    assert {v for d, v in got if d == "query_condition"} == {"photo"}


def test_recall_never_falls_with_k(spark):
    queries = spark.range(20).select(F.col("id").alias("query_id"))
    results = queries.select("query_id", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("rank")).withColumn(
        "product_id", (F.col("query_id") * 7 + F.col("rank") * 3) % 50
    )
    judged = queries.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n")).select(
        "query_id", (F.col("n") * 5 % 50).alias("product_id"), F.lit(1.0).alias("grade")
    )
    for r in metrics.query_metrics(queries, results, judged).collect():
        values = [r[f"recall_at_{k}"] for k in metrics.K_VALUES]
        assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1

import random

import pytest
from pyspark.sql import Window, functions as F

from vitrine.operators import skew


def skewed(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), rng.choice([rng.random(), 0.5]), i) for i in range(n)]
    return spark.createDataFrame(data, "key string, p double, id int")


@pytest.mark.parametrize("buckets", [1, 16, 1000])
def test_bucketed_rank_equals_row_number(spark, rows, buckets):
    df = skewed(spark)
    order = [F.desc("p"), F.asc("id")]
    got = skew.rank_in_groups(df, ["key"], F.floor((1 - F.col("p")) * buckets), order)
    expected = df.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    assert rows(got.select("key", "id", "rank")) == rows(expected.select("key", "id", "rank"))


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100])
@pytest.mark.parametrize("width", [1.0, 1000.0])
def test_nearest_rank(spark, n, width):
    rng = random.Random(n)
    values = [round(rng.random() * 300, rng.choice([0, 2])) for _ in range(n)]
    df = spark.createDataFrame([("v1", v) for v in values] + [("v2", 7.0)], "version string, ms double")
    got = skew.value_at_rank(
        df, ["version"], "ms", {"p50": lambda c: F.floor(c / 2), "p95": lambda c: F.floor(c * 0.95) - 1}, width
    ).where("version = 'v1'").first()
    ordered = sorted(values)
    assert (got["n"], got["p50"], got["p95"]) == (n, ordered[n // 2], ordered[int(0.95 * n) - 1])


def test_chunks_hold_every_value_once(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise("rare").alias("k"), "id")
    nested = skew.nest_in_chunks(df.unionAll(df), ["k"], "id", "ids", chunk_rows=50).collect()
    hot = sorted(i for r in nested if r["k"] == "hot" for i in r["ids"])
    assert hot == list(range(400))
    assert max(len(r["ids"]) for r in nested) < 120
    assert len([r for r in nested if r["k"] == "hot"]) == 8
    whole = skew.nest_in_chunks(df, ["k"], "id", "ids").collect()
    assert {r["chunk"] for r in whole} == {0} and len(whole) == 2


def test_small_table_is_broadcast_only_within_the_bound(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    plan = lambda side: df.join(side, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(skew.fetch_if_small(df.limit(5), 10)).lower()
    assert "broadcast" not in plan(skew.fetch_if_small(df, 10)).lower()


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("cells,passes", [(2, 1), (8, 3), (1024, 2)])
def test_radix_selection_equals_sorting(spark, seed, cells, passes):
    rng = random.Random(seed)
    special = [float("inf"), float("-inf"), float("nan"), 1e308, -1e308, 0.0, None]
    data = [("even", rng.random() * 300) for _ in range(200)] + [("steep", 2.0 ** rng.randrange(-40, 40)) for _ in range(150)]
    data += [(None, 5.0)] * 40 + [("odd", rng.choice(special)) for _ in range(60)] + [("huge", rng.choice([1e308, -1e308, rng.random()])) for _ in range(50)] + [("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    targets = {"p0": lambda n: n * 0, "p50": lambda n: F.floor(n / 2), "p95": lambda n: F.floor(n * 0.95) - 1}
    got = {r["k"]: tuple(map(str, r[1:])) for r in skew.select_ranks(df, ["k"], "v", targets, cells, passes).collect()}
    want = {}
    for key in {k for k, v in data if v is not None}:
        values = sorted((v for k, v in data if k == key and v is not None), key=lambda v: (v != v, v))
        n = len(values)
        want[key] = tuple(map(str, (n, values[0], values[n // 2], values[max(0, int(n * 0.95) - 1)])))
    assert got == want
    whole = skew.select_ranks(df.where("k = 'even'"), [], "v", targets, cells, passes).first()
    assert whole["n"] == 200 and whole["p50"] == sorted(v for k, v in data if k == "even")[100]


def test_radix_selection_shuffles_no_raw_value(spark):
    df = skewed(spark)
    plan = skew.select_ranks(df, ["key"], "p", {"p50": lambda n: F.floor(n / 2)})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

import random

import pytest
from pyspark.sql import Window, functions as F

from vitrine.operators import monitor


def log(spark, data, extra=""):
    schema = "event_id int, at string, session_id string, clicked array<int>, n_results int, latency_ms double, query_condition string, selected_category string"
    return spark.createDataFrame(data, schema).withColumn("event_ts", F.col("at").cast("timestamp"))


def row(n, at, clicked=(), n_results=5, ms=100.0, condition="photo", category="bag", session="s"):
    return (n, at, session, list(clicked), n_results, ms, condition, category)


@pytest.mark.parametrize("gap", [60, 600])
def test_reformulated_equals_lead_on_a_busy_session(spark, rows, gap):
    rng = random.Random(gap)
    data = [
        row(n, f"2024-01-0{rng.randint(1, 2)} {rng.randint(0, 3):02d}:{rng.randint(0, 59):02d}:{rng.choice([0, 0, 30]):02d}", session="hot" if rng.random() < 0.6 else str(n % 9))
        for n in range(400)
    ]
    events = log(spark, data)
    following = F.lead("event_ts").over(Window.partitionBy("session_id").orderBy("event_ts", "event_id"))
    expected = events.select("event_id", F.coalesce(F.unix_micros(following) - F.unix_micros("event_ts") <= gap * 1_000_000, F.lit(False)))
    assert rows(monitor.reformulated(events, gap).select("event_id", "reformulated")) == rows(expected)


def test_online_metrics_of_the_last_day(spark):
    events = log(spark, [
        row(1, "2024-01-30 00:00:00", [1], ms=10.0), row(2, "2024-01-30 05:00:00", n_results=0, ms=20.0), row(3, "2024-01-29 23:59:59", ms=999.0),
    ]).withColumn("reformulated", F.col("event_id") == 2)
    r = monitor.online_metrics(events, "2024-01-31").first()
    assert (r["n_searches"], r["ctr"], r["zero_result_rate"], r["reformulation_rate"], r["p95_latency"]) == (2, 0.5, 0.5, 0.5, 20.0)
    assert monitor.online_metrics(events, "2030-01-01").first()["n_searches"] == 0


def test_category_ctr_needs_enough_searches(spark):
    events = log(spark, [row(n, "2024-01-30 00:00:00", category="bag") for n in range(6)] + [row(9, "2024-01-30 00:00:00", category="hat")])
    got = monitor.category_ctr(events, "2024-01-31", monitor.Limits(min_category_searches=5)).collect()
    assert [(r["category"], r["n"]) for r in got] == [("bag", 6)]


def test_shift_counts_the_boundary_twice_and_needs_both_sides(spark):
    events = log(spark, [
        row(1, "2024-01-24 00:00:00", condition="a"), row(2, "2024-01-30 00:00:00", condition="new"), row(3, "2024-01-10 00:00:00", condition="old"),
        row(4, "2023-11-02 00:00:00", condition="a"), row(5, "2023-11-01 00:00:00", condition="a"),
    ])
    got = monitor.distribution_shift(events, "2024-01-31").collect()
    assert [(r["query_condition"], r["p_now"], pytest.approx(r["p_base"])) for r in got] == [("a", 0.5, 2 / 3)]


def test_freshness_grades(spark):
    times = spark.sql("SELECT k, cast(at AS timestamp) AS at FROM VALUES ('ok', '2024-01-30 19:00:00'), ('late', '2024-01-30 10:00:00'), ('dead', '2024-01-20 00:00:00') AS t(k, at)")
    got = {r["k"]: (r["hours"], r["severity"]) for r in monitor.freshness(times, "2024-01-31", "at", ["k"]).collect()}
    assert got == {"ok": (5, None), "late": (14, "warning"), "dead": (264, "high")}
    none = monitor.freshness(times.where("false"), "2024-01-31", "at").first()
    assert (none["kind"], none["severity"]) == ("no_index", "high")


def test_coverage_counts_products_not_rows(spark):
    products = spark.createDataFrame([(1,), (2,), (3,), (4,)], "product_id int")
    vectors = spark.createDataFrame([(1,), (1,), (1,), (2,), (99,)], "product_id int")
    r = monitor.coverage(products, vectors).first()
    assert (r["n_embedded"], r["coverage"], r["severity"]) == (2, 0.5, "high")


def test_folded_clicks(spark):
    events = spark.createDataFrame([(1, [5]), (2, [])], "event_id int, clicked array<int>")
    clicks = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (2, 7), (9, 1)], "event_id int, product_id int")
    assert {tuple(r) for r in monitor.fold_clicks(events, clicks).collect()} == {(1, 5), (1, 6), (2, 7)}


def test_alerts(spark):
    online = spark.createDataFrame([(10, 0.1, 0.5, 0.0, 300.0)], "n_searches int, ctr double, zero_result_rate double, reformulation_rate double, p95_latency double")
    trend = spark.sql("SELECT 'm' AS model_name, cast(at AS timestamp) AS evaluated_at, delta, degraded FROM VALUES ('2024-01-01', -0.5D, true), ('2024-01-02', 0.1D, false) AS t(at, delta, degraded)")
    raised = monitor.alerts("2024-01-31", online=online, trend=trend)
    assert sorted((r["kind"], r["severity"]) for r in raised.collect()) == [("latency", "high"), ("low_ctr", "high"), ("zero_results", "high")]
    assert '"kind":"latency"' in raised.where("kind = 'latency'").first()["payload"]
    with pytest.raises(RuntimeError, match="high"):
        monitor.fail_on_high(raised)
    quiet = monitor.alerts("2024-01-31", online=online.where("false"))
    assert quiet.count() == 0
    monitor.fail_on_high(quiet)
    silent = monitor.alerts("2024-01-31", online=spark.sql("SELECT 0 AS n_searches, cast(null AS double) AS ctr, cast(null AS double) AS zero_result_rate, cast(null AS double) AS reformulation_rate, cast(null AS double) AS p95_latency"))
    assert silent.count() == 0


def test_latency_by_version(spark):
    events = log(spark, [row(n, "2024-01-30 00:00:00", ms=float(n)) for n in range(1, 101)]).withColumn("model_version", F.lit("v1"))
    r = monitor.latency_summary(events, ["model_version"], 94.0).first()
    assert (r["p50_ms"], r["p95_ms"], r["within_budget"]) == (51.0, 95.0, False)


def test_days_filter_folders_while_the_query_runs(spark, tmp_path):
    from vitrine.sources.tables import Tables

    tables = Tables(spark, str(tmp_path))
    days = ["2024-01-01", "2024-01-02", "2024-01-03", None]
    events = spark.createDataFrame(
        [(d and f"{d} 10:00:00", "v", [1] if n else [], n) for d in days for n in (0, 1, 2)], "ts string, model_version string, clicked array<int>, n_results int"
    ).withColumn("event_ts", F.to_timestamp("ts"))
    tables.append_events(events, "gold", "e")
    stored = tables.read_events("gold", "e", "1970-01-01")
    bad = spark.createDataFrame([("2024-01-02",)], "d string").select(F.to_date("d").alias("event_date"))
    found = monitor.metrics_of_days(stored, bad)
    assert [(str(r["event_date"]), r["n_searches"], round(r["ctr"], 3)) for r in found.collect()] == [("2024-01-02", 3, 0.667)]
    path = str(tmp_path / "bad")
    bad.write.parquet(path)
    lazily = monitor.metrics_of_days(stored, spark.read.parquet(path).where("event_date < current_date()"))
    assert "dynamicpruning" in lazily._jdf.queryExecution().executedPlan().toString()
    assert monitor.bad_days(events, 0.2).count() == 4 and monitor.bad_days(events, 0.5).count() == 0

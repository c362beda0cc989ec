import pytest

from vitrine.operators import gate

CFG = gate.GateConfig(min_queries=40)
SCHEMA = "slice_dim string, slice_value string, n_queries long, recall_at_20 double, ndcg_at_20 double"
# The production model: overall, four categories of which one is small, one size band.
PRODUCTION = [
    ("overall", "all", 900, 0.61, 0.52), ("category", "shoes", 400, 0.70, 0.60), ("category", "bag", 60, 0.44, 0.40),
    ("category", "hat", 45, 0.50, 0.47), ("category", "outer", 12, 0.90, 0.80), ("size_band", "small", 80, 0.35, 0.30),
]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def moved(recall=0.0, ndcg=0.0, only=None, queries=None):
    """PRODUCTION with the measures of all or of one slice moved."""
    return [
        (d, v, queries if queries is not None and v == only else n, r + recall * (only in (None, v)), g + ndcg * (only in (None, v)))
        for d, v, n, r, g in PRODUCTION
    ]


def judged(spark, candidate, champion=None):
    rows = gate.gate_verdicts(table(spark, candidate), table(spark, PRODUCTION if champion is None else champion), CFG).collect()
    return {r["name"]: r for r in rows}


@pytest.mark.parametrize(
    "candidate, failed",
    [
        (moved(), set()),
        (moved(0.01, 0.02), set()),
        (moved(ndcg=-0.1, only="all"), {"overall_ndcg20_not_worse"}),
        (moved(-0.3, only="hat"), {"protected_slices_no_regression", "recall20_no_slice_regression"}),
        (moved(-0.6, only="outer"), set()),  # too small to judge
        (moved(only="bag", queries=5), {"protected_slice_coverage"}),
    ],
)
def test_which_checks_fail(spark, candidate, failed):
    got = judged(spark, candidate)
    assert {n for n, r in got.items() if not r["passed"]} == failed


def test_what_a_failure_reports(spark):
    r = judged(spark, moved(-0.25, 0.05, only="bag"))["protected_slices_no_regression"]
    assert (r["observed"], r["detail"]) == (pytest.approx(0.25), "worst: category=bag")
    r = judged(spark, [x for x in PRODUCTION if x[1] != "hat"])["protected_slice_coverage"]
    assert (r["passed"], r["detail"]) == (False, "too few queries: category=hat")


def test_unmeasured_slices_and_a_first_model_pass(spark):
    unmeasured = [(d, v, n, None, None) if v == "bag" else (d, v, n, r, g) for d, v, n, r, g in PRODUCTION]
    assert judged(spark, unmeasured)["protected_slices_no_regression"]["passed"]
    assert all(r["passed"] for r in judged(spark, PRODUCTION, []).values())


def test_report_names_every_check_and_the_outcome(spark):
    for candidate in (moved(), moved(-0.3, only="hat")):
        verdicts = gate.gate_verdicts(table(spark, candidate), table(spark, PRODUCTION), CFG)
        rows, report = verdicts.collect(), gate.gate_report(verdicts).first()
        assert report["passed"] == all(r["passed"] for r in rows)
        assert report["failures"] == ", ".join(sorted(r["name"] for r in rows if not r["passed"]))
        assert all(r["name"] in report["report"] for r in rows)


def test_alias_asof_and_champion_baseline(spark):
    moves = spark.sql("""
        SELECT 'encoder' AS model_name, alias, version, cast(at AS timestamp) AS moved_at FROM VALUES
        ('production', 1, '2024-01-01'), ('candidate', 2, '2024-01-10'), ('production', 2, '2024-01-20'), ('production', 1, '2024-01-25')
        AS t(alias, version, at)""")
    holder = lambda t: {r["alias"]: r["version"] for r in gate.alias_asof(moves, t).collect()}
    assert holder("2024-01-05") == {"production": 1}
    assert holder("2024-01-21") == {"production": 2, "candidate": 2}
    assert holder("2024-01-31") == {"production": 1, "candidate": 2}
    history = spark.sql("""
        SELECT 'encoder' AS model_name, v AS model_version, cast(at AS timestamp) AS evaluated_at, n FROM VALUES
        ('1', '2024-01-02', 10), ('1', '2024-01-03', 11), ('2', '2024-01-21', 20) AS t(v, at, n)""")
    pick = lambda t: [r["n"] for r in gate.champion_baseline(history, moves, "encoder", "production", t).collect()]
    assert pick("2024-01-21") == [20]
    assert pick("2024-01-31") == [11]
    assert pick("2023-12-31") == []


def test_trend(spark):
    history = spark.sql("""
        SELECT 'overall' AS slice_dim, 'm' AS model_name, v AS model_version, cast(at AS timestamp) AS evaluated_at, 10 AS n_queries,
               0.5D AS recall_at_20, ndcg AS ndcg_at_20, 0.5D AS mrr
        FROM VALUES ('1', '2024-01-01', 0.50D), ('1', '2024-01-02', 0.51D), ('1', '2024-01-03', 0.508D), ('1', '2024-01-04', 0.40D) AS t(v, at, ndcg)""")
    got = [(r["trend"], r["degraded"]) for r in gate.metric_trend(history).orderBy("evaluated_at").collect()]
    assert got == [("first", False), ("improved", False), ("held steady", False), ("declined", True)]


def test_retention(spark):
    schema = "slice_dim string, slice_value string, recall_at_50 double"
    of = lambda v: spark.createDataFrame([("overall", "all", v)], schema)
    assert gate.matryoshka_retention(of(0.76), of(0.80)).first()["passed"]
    assert not gate.matryoshka_retention(of(0.75), of(0.80)).first()["passed"]
    assert gate.matryoshka_retention(of(0.5), of(0.0)).first()["observed"] == 0.0

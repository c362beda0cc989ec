import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import drift


def counts(spark, pairs):
    return spark.createDataFrame([(str(k), int(n)) for k, n in pairs.items()], "key string, n long")


def psi(spark, before, after):
    return drift.psi(counts(spark, before), counts(spark, after)).first()


def js(spark, p, q):
    return drift.js_distance(counts(spark, dict(enumerate(p))), counts(spark, dict(enumerate(q)))).first()["js"]


def psi_by_hand(before, after, epsilon=1e-6):
    total = [sum(d.values()) for d in (before, after)]
    out = 0.0
    for key in before.keys() | after.keys():
        p, q = max(before.get(key, 0) / total[0], epsilon), max(after.get(key, 0) / total[1], epsilon)
        out += (q - p) * math.log(q / p)
    return out


WEEKS = [
    {"de": 400, "fr": 350, "it": 250}, {"de": 4000, "fr": 3500, "it": 2500}, {"de": 395, "fr": 360, "it": 245},
    {"de": 300, "fr": 350, "it": 350}, {"de": 90, "fr": 10, "it": 900}, {"de": 700, "fr": 300}, {"es": 5, "de": 400, "fr": 350, "it": 250},
]


@pytest.mark.parametrize("before", range(3))
@pytest.mark.parametrize("after", range(len(WEEKS)))
def test_psi_against_the_formula(spark, before, after):
    row = psi(spark, WEEKS[before], WEEKS[after])
    want = psi_by_hand(WEEKS[before], WEEKS[after])
    assert row["psi"] == pytest.approx(want, abs=1e-4)
    assert row["verdict"] == ("stable" if want < 0.10 else "moderate shift" if want < 0.25 else "significant shift")


def test_psi_without_counts(spark):
    assert psi(spark, {}, {})["psi"] == 0.0


def js_by_hand(p, q):
    p, q = (np.array(x, float) / sum(x) for x in (p, q))
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


@pytest.mark.parametrize("seed", range(4))
def test_js_against_the_formula_and_its_bounds(spark, seed):
    rng = random.Random(seed)
    p, q = ([rng.choice([0, rng.randint(1, 90)]) + (n == 0) for n in range(9)] for _ in range(2))
    assert js(spark, p, q) == pytest.approx(js_by_hand(p, q), abs=1e-6)
    assert js(spark, q, p) == pytest.approx(js(spark, p, q))
    assert js(spark, p, [7 * n for n in p]) == pytest.approx(0.0, abs=1e-6)
    apart = js(spark, p + [0] * 9, [0] * 9 + q)
    assert apart == pytest.approx(1.0)


def vectors(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "embedding array<double>")


def shift(spark, before, after):
    return drift.centroid_shift(vectors(spark, before), vectors(spark, after)).first()["shift"]


def test_centroid_shift_is_one_minus_the_cosine_of_the_means(spark):
    rng = np.random.default_rng(5)
    before, after = rng.normal(0.4, 1, (30, 6)), rng.normal([0.4, 0.4, 0.4, -0.4, 0, 0], 1, (50, 6))
    m, n = before.mean(0), after.mean(0)
    assert shift(spark, before.tolist(), after.tolist()) == pytest.approx(1 - m @ n / np.linalg.norm(m) / np.linalg.norm(n))
    assert shift(spark, before.tolist(), (3 * before).tolist()) == pytest.approx(0.0, abs=1e-9)
    assert shift(spark, before.tolist(), []) is None
    assert shift(spark, [[2.0, 0.5], [-2.0, -0.5]], [[1.0, 1.0]]) is None


def test_histogram_matches_numpy(spark):
    rng = random.Random(3)
    values = [i / 20 for i in range(-2, 24)] + [i * 0.1 for i in range(11)] + [rng.random() for _ in range(200)] + [float("nan")]
    got = drift.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v").orderBy("bin").collect()
    finite = [v for v in values if 0 <= v <= 1]
    assert [r["n"] for r in got] == np.histogram(finite, bins=20, range=(0, 1))[0].tolist()


def snapshot(spark, entries):
    return spark.createDataFrame([(s, k, float(v)) for s, k, v in entries], "signal string, key string, value double")


FULL = [
    ("category_counts", "top", 50), ("category_counts", "bag", 50), ("size_band_counts", "small", 5), ("confidence_hist", "0", 1),
    ("confidence_hist", "1", 20), ("fallback_rate", "all", 0.05), ("mean_confidence", "all", 0.72), ("centroid", "0", 1.0), ("centroid", "1", 0.5),
]


def test_report_of_equal_snapshots_is_stable(spark):
    rows = drift.drift_report(snapshot(spark, FULL), snapshot(spark, FULL)).collect()
    assert len(rows) == 6 and {r["verdict"] for r in rows} == {"stable"}


def test_report_skips_what_one_side_lacks(spark):
    assert drift.drift_report(snapshot(spark, []), snapshot(spark, [("fallback_rate", "all", 0.05)])).count() == 0
    only = drift.drift_report(snapshot(spark, [("fallback_rate", "all", 0.0)]), snapshot(spark, [("fallback_rate", "all", 0.2)])).collect()
    assert [(r["signal"], r["value"], r["verdict"]) for r in only] == [("detector_fallback_rate", 0.2, "significant shift")]


def test_snapshot_payload_is_json_per_signal(spark):
    got = {r["signal"]: r["payload"] for r in drift.snapshot_payload(snapshot(spark, FULL)).collect()}
    assert got["category_counts"] == '{"bag":50.0,"top":50.0}'
    assert len(got) == 6


def test_snapshot_of_rows(spark):
    products = spark.createDataFrame([(1, "bag"), (2, "bag"), (3, "hat")], "product_id int, category string")
    queries = spark.createDataFrame([("small", [1.0, 0.0]), ("large", [0.0, 1.0])], "size_band string, embedding array<double>")
    scores = spark.createDataFrame([(0.5,), (0.7,)], "score double")
    items = spark.createDataFrame([(1, 0, True), (2, 0, False), (2, 1, False)], "post_id int, item_index int, used_whole_image boolean")
    got = {(r["signal"], r["key"]): r["value"] for r in drift.snapshot(products, queries, scores, items).where(F.col("value") > 0).collect()}
    assert got == {
        ("category_counts", "bag"): 2, ("category_counts", "hat"): 1, ("size_band_counts", "small"): 1, ("size_band_counts", "large"): 1,
        ("confidence_hist", "10"): 1, ("confidence_hist", "13"): 1, ("centroid", "0"): 0.5, ("centroid", "1"): 0.5,
        ("fallback_rate", "all"): 0.5, ("mean_confidence", "all"): pytest.approx(0.6), ("table_size", "n_products"): 3, ("table_size", "n_eval_queries"): 2,
    }


def test_newest_two_captures(spark):
    log = spark.sql("SELECT s, cast(at AS timestamp) AS captured_at FROM VALUES (1, '2024-01-01'), (2, '2024-01-02'), (3, '2024-01-03'), (33, '2024-01-03') AS t(s, at)")
    values = lambda df: sorted(r["s"] for r in df.collect())
    previous, current = drift.newest_two(log)
    assert (values(previous), values(current)) == ([2], [3, 33])
    previous, current = drift.newest_two(log.where("s = 1"))
    assert (values(previous), values(current)) == ([], [1])


def test_payloads_are_read_back_and_bad_ones_set_aside(spark, rows):
    snap = spark.createDataFrame(
        [("counts", "top", 3.0), ("counts", "bag", 0.1 + 0.2), ("rate", "all", None), ("odd \"key\"", "a\\b", -1e-17)], "signal string, key string, value double"
    )
    log = drift.payloads(snap, "2024-01-01", "7")
    bad = ["{", None, "[]", '{"signal": null, "values": {"a": 1}}', '{"signal": "x", "values": 3}', '{"values": {}}', ""]
    broken = spark.createDataFrame([(b,) for b in bad], "payload string").selectExpr(
        "timestamp'2024-01-02 00:00:00' AS captured_at", "'8' AS model_version", "payload")
    good, aside = drift.read_payloads(log.unionByName(broken))
    assert rows(good.select("signal", "key", "value")) == rows(snap)
    assert {r["model_version"] for r in good.collect()} == {"7"}
    assert sorted(map(repr, (r["payload"] for r in aside.collect()))) == sorted(map(repr, bad))

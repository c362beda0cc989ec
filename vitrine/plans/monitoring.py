"""Registered monitoring and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import drift, gate, infer, monitor
from ..session import work_dir
from ..sources.tables import Tables
from .evaluation import HISTORY_SQL, history
from .inputs import AS_OF
from .registry import query, rounded, stored, text_time

_DAY = f"DATE '{AS_OF}'"

_ONLINE = f"""
SELECT count(*) AS n_searches, avg((len(clicked) > 0)::INT) AS ctr, avg((n_results = 0)::INT) AS zero_result_rate,
       avg(reformulated::INT) AS reformulation_rate, quantile_disc(latency_ms, 0.95) AS p95_latency
FROM f_flagged_events WHERE event_ts >= {_DAY} - INTERVAL 1 DAY"""
_ONLINE_ROUNDED = """n_searches, round(ctr, 6) + 0 AS ctr, round(zero_result_rate, 6) + 0 AS zero_result_rate,
round(reformulation_rate, 6) + 0 AS reformulation_rate, round(p95_latency, 6) AS p95_latency"""


@query("online_metrics", f"SELECT {_ONLINE_ROUNDED} FROM ({_ONLINE}) t")
def online_metrics(i):
    return rounded(
        monitor.online_metrics(monitor.reformulated(monitor.since(i.events(), AS_OF, 1)), AS_OF), "ctr", "zero_result_rate", "reformulation_rate", "p95_latency"
    )


_CATEGORY_CTR = f"""
SELECT selected_category AS category, avg((len(clicked) > 0)::INT) AS ctr, count(*) AS n
FROM f_events WHERE event_ts >= {_DAY} - INTERVAL 7 DAY GROUP BY 1 HAVING count(*) > 200 AND avg((len(clicked) > 0)::INT) < 0.4"""
LIMITS = monitor.Limits(min_ctr=0.4)


@query("category_ctr", f"SELECT category, round(ctr, 6) AS ctr, n FROM ({_CATEGORY_CTR}) t")
def category_ctr(i):
    return rounded(monitor.category_ctr(i.events(), AS_OF, LIMITS), "ctr")


@query("reformulation", "SELECT event_id, session_id, reformulated FROM f_flagged_events")
def reformulation(i):
    return i.flagged_events().select("event_id", "session_id", "reformulated")


@query(
    "fold_clicks",
    """
SELECT event_id, unnest(clicked) AS product_id FROM f_events UNION SELECT event_id, product_id FROM f_later_clicks""",
)
def fold_clicks(i):
    return monitor.fold_clicks(i.events(), i.later_clicks())


_SHIFT = f"""
WITH n AS (SELECT query_condition, count(*) FILTER (event_ts >= {_DAY} - INTERVAL 7 DAY) AS now,
                  count(*) FILTER (event_ts BETWEEN {_DAY} - INTERVAL 90 DAY AND {_DAY} - INTERVAL 7 DAY) AS base FROM f_events GROUP BY 1)
SELECT query_condition, now / (SELECT sum(now) FROM n) AS p_now, base / (SELECT sum(base) FROM n) AS p_base,
       abs(now / (SELECT sum(now) FROM n) - base / (SELECT sum(base) FROM n)) AS shift FROM n WHERE now > 0 AND base > 0"""


@query(
    "online_by_day",
    f"""
WITH days AS (SELECT date_trunc('day', event_ts)::DATE AS day, count(*) AS n FROM f_events GROUP BY 1 HAVING count(*) FILTER (n_results = 0) / count(*) > 0.2)
SELECT strftime(d.day, '%Y-%m-%d') AS day, e.model_version, count(*) AS n_searches, round(avg((len(clicked) > 0)::INT), 6) AS ctr, round(avg((n_results = 0)::INT), 6) AS zero_result_rate
FROM days d JOIN f_events e ON date_trunc('day', e.event_ts)::DATE = d.day GROUP BY ALL""",
)
def online_by_day(i):
    """Metrics of the days that a summary marks as bad: their folders alone are read, by a dynamic partition filter."""
    tables = Tables(i.spark, work_dir(i.spark, "days"))
    tables.append_events(i.events(), "gold", "search_events")
    events = tables.read_events("gold", "search_events", "1970-01-01")
    bad = stored(monitor.bad_days(i.events(), 0.2), "bad-days")
    return rounded(
        monitor.metrics_of_days(events, bad).select(F.date_format("event_date", "yyyy-MM-dd").alias("day"), "model_version", "n_searches", "ctr", "zero_result_rate"),
        "ctr", "zero_result_rate",
    )


@query("distribution_shift", f"SELECT query_condition, round(p_now, 6) AS p_now, round(p_base, 6) AS p_base, round(shift, 6) AS shift FROM ({_SHIFT}) t")
def distribution_shift(i):
    return rounded(monitor.distribution_shift(i.events(), AS_OF), "p_now", "p_base", "shift")


# There is an index for every second number up to twice the suppliers; those beyond the users were never synced.
_FRESH = f"""
SELECT index_name, max(synced_at) AS last_at, date_sub('hour', max(synced_at), TIMESTAMP '{AS_OF}') AS hours,
       CASE WHEN max(synced_at) IS NULL THEN 'no_index' ELSE 'index_stale' END AS kind,
       CASE WHEN max(synced_at) IS NULL THEN 'high' WHEN date_sub('hour', max(synced_at), TIMESTAMP '{AS_OF}') > 24 THEN 'high'
            WHEN date_sub('hour', max(synced_at), TIMESTAMP '{AS_OF}') > 6 THEN 'warning' END AS severity
FROM (SELECT concat('index_', 2 * s_suppkey) AS index_name, NULL AS synced_at FROM supplier UNION ALL SELECT index_name, synced_at FROM f_index_syncs) x
GROUP BY index_name"""


def _fresh(i):
    expected = i.raw("supplier").selectExpr("concat('index_', 2 * s_suppkey) AS index_name")
    return monitor.freshness(i.index_syncs(), AS_OF, "synced_at", ["index_name"], expected=expected)


@query("freshness", f"SELECT index_name, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_at, hours, kind, severity FROM ({_FRESH}) t")
def freshness(i):
    return text_time(_fresh(i), "last_at")


@query(
    "sync_log",
    "SELECT 'catalogue' AS index_name, '2024-01-31 00:00:00' AS synced_at, count(*) AS n_vectors FROM embeddings",
)
def sync_log(i):
    return text_time(monitor.sync_record("catalogue", i.catalogue(), AS_OF), "synced_at")


_COVERAGE = """
SELECT count(*) AS n_products, count(e.product_id) AS n_embedded, count(e.product_id) / count(*) AS coverage
FROM f_products p LEFT JOIN (SELECT DISTINCT product_id FROM f_catalogue) e USING (product_id)"""


@query("coverage", f"SELECT n_products, n_embedded, round(coverage, 6) AS coverage, CASE WHEN coverage < 0.99 THEN 'high' END AS severity FROM ({_COVERAGE}) t")
def coverage(i):
    return rounded(monitor.coverage(i.products(), i.catalogue()), "coverage")


@query(
    "latency_summary",
    """
SELECT model_version, n, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms, p95_ms <= 250 AS within_budget FROM (
  SELECT model_version, count(*) AS n, list_sort(list(latency_ms))[count(*) // 2 + 1] AS p50_ms,
         list_sort(list(latency_ms))[greatest(floor(0.95::DOUBLE * count(*))::BIGINT, 1)] AS p95_ms
  FROM f_events GROUP BY model_version) t""",
)
def latency_summary(i):
    return rounded(monitor.latency_summary(i.events(), ["model_version"]), "p50_ms", "p95_ms")


@query(
    "serving_history",
    """
SELECT strftime(checked_at, '%Y-%m-%d %H:%M:%S') AS checked_at, model_version, n, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms,
       p95_ms <= 120 AS within_budget, 120::DOUBLE AS budget_ms FROM (
  SELECT date_trunc('day', event_ts) AS checked_at, model_version, count(*) AS n, list_sort(list(latency_ms))[count(*) // 2 + 1] AS p50_ms,
         list_sort(list(latency_ms))[greatest(floor(0.95::DOUBLE * count(*))::BIGINT, 1)] AS p95_ms
  FROM f_events GROUP BY ALL) t ORDER BY t.checked_at DESC, model_version LIMIT 10""",
)
def serving_history(i):
    checks = monitor.serving_history(monitor.serving_checks(i.events(), 120.0))
    return rounded(text_time(checks, "checked_at"), "p50_ms", "p95_ms")


@query(
    "recent_events",
    """
SELECT event_id, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, selected_category, model_version, n_results,
       round(latency_ms, 6) AS latency_ms, len(clicked)::INT AS n_clicks FROM f_events ORDER BY f_events.event_ts DESC, event_id DESC LIMIT 20""",
)
def recent_events(i):
    return rounded(text_time(monitor.recent_events(i.events()), "event_ts"), "latency_ms")


_TREND = f"""
SELECT model_name, arg_max(delta, evaluated_at) AS delta FROM (
  SELECT *, ndcg_at_20 - lag(ndcg_at_20) OVER (PARTITION BY model_name ORDER BY evaluated_at) AS delta
  FROM ({HISTORY_SQL}) h WHERE slice_dim = 'overall') t GROUP BY model_name"""


@query(
    "alerts",
    f"""
SELECT kind, severity, round(value, 6) + 0 AS value, subject FROM (
  SELECT 'low_ctr' AS kind, 'high' AS severity, ctr AS value, NULL::VARCHAR AS subject FROM ({_ONLINE}) o WHERE ctr < 0.4
  UNION ALL SELECT 'zero_results', 'high', zero_result_rate, NULL FROM ({_ONLINE}) o WHERE zero_result_rate > 0.04
  UNION ALL SELECT 'high_reformulation', 'warning', reformulation_rate, NULL FROM ({_ONLINE}) o WHERE reformulation_rate > 0.3
  UNION ALL SELECT 'latency', 'high', p95_latency, NULL FROM ({_ONLINE}) o WHERE p95_latency > 250
  UNION ALL SELECT 'category_ctr_low', 'warning', ctr, category FROM ({_CATEGORY_CTR}) c
  UNION ALL SELECT 'query_distribution_drift', 'warning', shift, query_condition FROM ({_SHIFT}) s WHERE shift > 0.15
  UNION ALL SELECT kind, severity, hours, index_name FROM ({_FRESH}) f WHERE severity IS NOT NULL
  UNION ALL SELECT 'incomplete_index', 'high', coverage, NULL FROM ({_COVERAGE}) v WHERE coverage < 0.99
  UNION ALL SELECT 'champion_degraded', 'high', delta, model_name FROM ({_TREND}) t WHERE delta < -0.02) a""",
)
def alerts(i):
    raised = monitor.alerts(
        AS_OF,
        online=monitor.online_metrics(monitor.reformulated(monitor.since(i.events(), AS_OF, 1)), AS_OF),
        categories=monitor.category_ctr(i.events(), AS_OF, LIMITS),
        shift=monitor.distribution_shift(i.events(), AS_OF),
        fresh=_fresh(i),
        covered=monitor.coverage(i.products(), i.catalogue()),
        trend=gate.metric_trend(history(i)),
        limits=LIMITS,
    )
    return rounded(raised, "value").select("kind", "severity", "value", "subject")


# Drift: the search log before and since 2024-01-24, products by return flag of their sales.
_SPLIT = "TIMESTAMP '2024-01-24 00:00:00'"


def _periods(i):
    events = i.events()
    cut = F.lit("2024-01-24").cast("timestamp")
    return events.where(F.col("event_ts") < cut), events.where(F.col("event_ts") >= cut)


_PSI = """
SELECT coalesce(sum((a - e) * ln(a / e)), 0) AS psi FROM (
  SELECT greatest(coalesce(x.n, 0) / (SELECT sum(n) FROM b4), 1e-6) AS e, greatest(coalesce(y.n, 0) / (SELECT sum(n) FROM aft), 1e-6) AS a
  FROM b4 x FULL JOIN aft y USING (key)) t"""
_PSI_VERDICT = "CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate shift' ELSE 'significant shift' END AS verdict"


@query(
    "psi",
    f"""
WITH b4 AS (SELECT query_condition AS key, count(*) AS n FROM f_events WHERE event_ts < {_SPLIT} GROUP BY 1),
aft AS (SELECT query_condition AS key, count(*) AS n FROM f_events WHERE event_ts >= {_SPLIT} GROUP BY 1)
SELECT round(psi, 6) + 0 AS psi, {_PSI_VERDICT} FROM ({_PSI}) p""",
)
def psi(i):
    before, after = _periods(i)
    return rounded(drift.psi(drift.counts_by(before, "query_condition"), drift.counts_by(after, "query_condition")), "psi")


def _hist_sql(where: str, value: str = "score", source: str = "f_detections") -> str:
    step = "0.05::DOUBLE"
    return f"""
SELECT bin, count(*) AS n FROM (
  SELECT CASE WHEN v >= 1 THEN 19 WHEN v < b * {step} THEN b - 1 WHEN v >= (b + 1) * {step} THEN b + 1 ELSE b END AS bin
  FROM (SELECT {value} AS v, floor({value} / {step})::INT AS b FROM {source} WHERE {where}) s WHERE v >= 0 AND v <= 1) t GROUP BY bin"""


@query(
    "confidence_hist",
    f"SELECT r.bin::INT AS bin, coalesce(h.n, 0) AS n FROM range(20) r(bin) LEFT JOIN ({_hist_sql('true', 'l_discount * 10', 'lineitem')}) h USING (bin)",
)
def confidence_hist(i):
    values = i.raw("lineitem").selectExpr("l_discount * 10 AS v")
    return drift.histogram(values, "v")


_JS = """
SELECT sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / greatest((p + q) / 2, 1e-12)) ELSE 0 END) / 2
                   + sum(CASE WHEN q > 0 THEN q * log2(q / greatest((p + q) / 2, 1e-12)) ELSE 0 END) / 2, 0)) AS js
FROM (SELECT coalesce(x.n, 0) / (SELECT sum(n) FROM h1) AS p, coalesce(y.n, 0) / (SELECT sum(n) FROM h2) AS q FROM h1 x FULL JOIN h2 y USING (bin)) t"""
_JS_VERDICT = "CASE WHEN js < 0.10 THEN 'stable' WHEN js < 0.20 THEN 'moderate shift' ELSE 'significant shift' END AS verdict"


@query(
    "js_distance",
    f"WITH h1 AS ({_hist_sql('area_frac >= 0.25')}), h2 AS ({_hist_sql('area_frac < 0.25', 'score * 0.8')}) SELECT round(js, 6) + 0 AS js, {_JS_VERDICT} FROM ({_JS}) j",
)
def js_distance(i):
    """Confidence of large boxes against the damped confidence of small ones."""
    hist = lambda df: drift.histogram(df, "score").select(F.col("bin").cast("string").alias("key"), "n")
    large = i.detections().where("area_frac >= 0.25")
    small = i.detections().where("area_frac < 0.25").withColumn("score", F.col("score") * 0.8)
    return rounded(drift.js_distance(hist(large), hist(small)), "js")


_MEANS = """
SELECT {by}, pos, avg(v) AS v FROM (SELECT {by}, unnest(embedding) AS v, unnest(range(64)) AS pos FROM {source} WHERE {where}) t GROUP BY {by}, pos"""


@query("centroid", "SELECT category, pos::INT AS pos, round(v, 6) + 0 AS value FROM (" + _MEANS.format(by="category", source="f_catalogue", where="true") + ") m")
def centroid(i):
    means = V.mean_vector(i.catalogue(), by=["category"])
    return rounded(means.select("category", F.posexplode("centroid").alias("pos", "value")), "value")


@query(
    "centroid_shift",
    "WITH b AS (" + _MEANS.format(by="1 AS one", source="f_queries", where="label < 5").replace("GROUP BY 1 AS one", "GROUP BY one").replace("SELECT 1 AS one, pos", "SELECT one, pos") + "), "
    "a AS (" + _MEANS.format(by="1 AS one", source="f_queries", where="label >= 5").replace("GROUP BY 1 AS one", "GROUP BY one").replace("SELECT 1 AS one, pos", "SELECT one, pos") + ") "
    "SELECT round(1 - sum(a.v * b.v) / sqrt(sum(a.v * a.v) * sum(b.v * b.v)), 6) AS shift FROM a JOIN b USING (pos)",
)
def centroid_shift(i):
    q = i.queries()
    return rounded(drift.centroid_shift(q.where("label < 5"), q.where("label >= 5")), "shift")


def _snapshot(i, early: bool):
    """Inputs of one period: labels below and from 5, sales before and since late April 1998."""
    sales = i.raw("orders").selectExpr("o_orderkey AS post_id", "o_orderdate < timestamp_ntz'1998-04-25 00:00:00' AS early")
    posts = sales.where(F.col("early") == early).select("post_id")
    boxes = i.detections().join(posts, "post_id", "left_semi")
    halves = "label < 5" if early else "label >= 5"
    return drift.snapshot(
        i.products().where(F.col("region") == ("JP" if early else "KR")), i.queries().where(halves), boxes,
        infer.first_items(posts, boxes.where("score > 0.6")),
    )


def _snapshot_sql(early: bool) -> str:
    half = "label < 5" if early else "label >= 5"
    region = "JP" if early else "KR"
    cond = "o_orderdate < TIMESTAMP '1998-04-25'" if early else "o_orderdate >= TIMESTAMP '1998-04-25'"
    boxes = f"(SELECT d.* FROM f_detections d WHERE post_id IN (SELECT o_orderkey FROM orders WHERE {cond}))"
    return f"""
SELECT 'category_counts' AS signal, category AS key, count(*)::DOUBLE AS value FROM f_products WHERE region = '{region}' GROUP BY 2
UNION ALL SELECT 'size_band_counts', size_band, count(*)::DOUBLE FROM f_queries WHERE {half} GROUP BY 2
UNION ALL SELECT 'confidence_hist', r.bin::VARCHAR, coalesce(h.n, 0)::DOUBLE FROM range(20) r(bin) LEFT JOIN ({_hist_sql('true', source=boxes + ' d')}) h USING (bin)
UNION ALL SELECT 'centroid', pos::VARCHAR, avg(v) FROM (SELECT unnest(embedding) AS v, unnest(range(64)) AS pos FROM f_queries WHERE {half}) c GROUP BY pos
UNION ALL SELECT 'fallback_rate', 'all', round(1 - count(DISTINCT b.post_id) / count(DISTINCT o_orderkey), 4)
  FROM orders LEFT JOIN {boxes} b ON b.post_id = o_orderkey AND b.score > 0.6 WHERE {cond}
UNION ALL SELECT 'mean_confidence', 'all', avg(score) FROM {boxes} b
UNION ALL SELECT 'table_size', 'n_products', count(*)::DOUBLE FROM f_products WHERE region = '{region}'
UNION ALL SELECT 'table_size', 'n_eval_queries', count(*)::DOUBLE FROM f_queries WHERE {half}"""


@query("drift_snapshot", f"SELECT signal, key, round(value, 6) + 0 AS value FROM ({_snapshot_sql(True)}) s")
def drift_snapshot(i):
    return rounded(_snapshot(i, True), "value")


def _psi_of(signal: str) -> str:
    part = lambda s: f"(SELECT key, value AS n FROM {s} WHERE signal = '{signal}')"
    sql = _PSI.replace("FROM b4)", f"FROM {part('prev')} z)").replace("FROM aft)", f"FROM {part('cur')} z)")
    return sql.replace("FROM b4 x FULL JOIN aft y", f"FROM {part('prev')} x FULL JOIN {part('cur')} y")


@query(
    "drift_report",
    f"""
WITH prev AS ({_snapshot_sql(True)}), cur AS ({_snapshot_sql(False)}),
h1 AS (SELECT key AS bin, value AS n FROM prev WHERE signal = 'confidence_hist'),
h2 AS (SELECT key AS bin, value AS n FROM cur WHERE signal = 'confidence_hist'),
d AS (SELECT c.signal, c.value - p.value AS delta FROM cur c JOIN prev p USING (signal, key) WHERE signal IN ('fallback_rate', 'mean_confidence')),
s AS (SELECT 1 - sum(p.value * c.value) / sqrt(sum(p.value * p.value) * sum(c.value * c.value)) AS shift
      FROM cur c JOIN prev p USING (signal, key) WHERE signal = 'centroid')
SELECT 'category_mix' AS signal, 'PSI' AS metric, round(psi, 4) + 0 AS value, {_PSI_VERDICT} FROM ({_psi_of('category_counts')}) p
UNION ALL SELECT 'query_size_bands', 'PSI', round(psi, 4) + 0, {_PSI_VERDICT} FROM ({_psi_of('size_band_counts')}) p
UNION ALL SELECT 'detector_confidence', 'JS distance', round(js, 4) + 0, {_JS_VERDICT} FROM ({_JS}) j
UNION ALL SELECT 'detector_fallback_rate', 'absolute change', round(delta, 4) + 0, CASE WHEN abs(delta) < 0.1 THEN 'stable' ELSE 'significant shift' END FROM d WHERE signal = 'fallback_rate'
UNION ALL SELECT 'mean_confidence', 'absolute change', round(delta, 4) + 0, CASE WHEN abs(delta) < 0.05 THEN 'stable' ELSE 'significant shift' END FROM d WHERE signal = 'mean_confidence'
UNION ALL SELECT 'query_embedding_centroid', 'cosine distance', round(shift, 5) + 0, CASE WHEN abs(shift) < 0.05 THEN 'stable' ELSE 'significant shift' END FROM s""",
)
def drift_report(i):
    """Two captures are stored as JSON payloads, and a broken one with them; the report reads the newest two back."""
    captures = drift.payloads(_snapshot(i, True), "2024-01-30", "1").unionByName(drift.payloads(_snapshot(i, False), AS_OF, "2"))
    broken = i.spark.range(1).select(F.lit("2024-02-01").cast("timestamp").alias("captured_at"), F.lit("3").alias("model_version"), F.lit('{"signal": "cen').alias("payload"))
    log, _ = drift.read_payloads(stored(captures.unionByName(broken), "snapshots"))
    report = drift.drift_report(*drift.newest_two(log))
    return report.withColumn("value", F.col("value") + F.lit(0.0))

"""Search-log metrics, freshness and coverage checks, alerts and click folding.

Every time window is relative to an explicit ``as_of`` date.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import whole_hours
from .skew import select_ranks


@dataclass(frozen=True)
class Limits:
    min_ctr: float = 0.18
    max_zero_rate: float = 0.04
    max_reformulation_rate: float = 0.30
    max_p95_ms: float = 250.0
    min_category_searches: int = 200
    max_stale_hours: float = 6.0
    min_coverage: float = 0.99
    max_condition_shift: float = 0.15


def day(as_of, days_back: int) -> Column:
    """Midnight ``days_back`` days before ``as_of``."""
    return F.date_sub(F.lit(as_of).cast("date"), days_back).cast("timestamp")


def _rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def clicked_any() -> Column:
    return F.size("clicked") > 0


def since(events: DataFrame, as_of, days: int) -> DataFrame:
    """Events from midnight ``days`` days before ``as_of``; skips whole day folders if there are any."""
    if "event_date" in events.columns:
        events = events.where(F.col("event_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return events.where(F.col("event_ts") >= day(as_of, days))


def online_metrics(events: DataFrame, as_of, days: int = 1, by: list[str] | None = None) -> DataFrame:
    """Searches, click-through, zero-result and reformulation rates, p95 latency."""
    recent, keys = since(events, as_of, days), by or []
    rates = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_searches"),
        _rate(clicked_any()).alias("ctr"),
        _rate(F.col("n_results") == 0).alias("zero_result_rate"),
        _rate(F.col("reformulated")).alias("reformulation_rate"),
    )
    # Exact at any size: the value at the nearest rank.
    p95 = select_ranks(recent, keys, "latency_ms", {"p95_latency": lambda n: F.ceil(n * 95 / 100) - 1}).drop("n")
    if not keys:
        return rates.withColumn("p95_latency", p95.scalar())
    same = [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys]
    named = p95.withColumnsRenamed({k: f"_p_{k}" for k in keys})
    return rates.join(named, same, "left").drop(*[f"_p_{k}" for k in keys])


def bad_days(events: DataFrame, max_zero_rate: float) -> DataFrame:
    """(event_date): days on which too large a share of the searches found nothing."""
    daily = events.groupBy(F.to_date("event_ts").alias("event_date")).agg(_rate(F.col("n_results") == 0).alias("rate"))
    return daily.where(F.col("rate") > max_zero_rate).select("event_date")


def metrics_of_days(events: DataFrame, days: DataFrame) -> DataFrame:
    """Metrics per day and model version of the given days. ``events`` is partitioned by ``event_date``, so that the
    days, one row each, filter its folders while the query runs."""
    return events.join(F.broadcast(days), "event_date").groupBy("event_date", "model_version").agg(
        F.count(F.lit(1)).alias("n_searches"), _rate(clicked_any()).alias("ctr"), _rate(F.col("n_results") == 0).alias("zero_result_rate"),
    )


def category_ctr(events: DataFrame, as_of, limits: Limits = Limits(), days: int = 7) -> DataFrame:
    """Categories with enough searches whose click-through is below the floor."""
    return (
        since(events, as_of, days)
        .groupBy(F.col("selected_category").alias("category"))
        .agg(_rate(clicked_any()).alias("ctr"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > limits.min_category_searches) & (F.col("ctr") < limits.min_ctr))
    )


def reformulated(events: DataFrame, gap_seconds: int = 600) -> DataFrame:
    """Flag searches followed by another search of the same session within the gap.

    Sessions are cut into time cells as wide as the gap, so a busy session is
    spread over its cells. The next search is either in the same cell or the
    earliest of the following one. A search without a session is never flagged.
    """
    micros = F.unix_micros("event_ts")
    gap = gap_seconds * 1_000_000
    cells = events.withColumn("_t", micros).withColumn("_cell", F.floor(F.col("_t") / gap))
    order = Window.partitionBy("session_id", "_cell").orderBy("_t", "event_id")
    following = cells.groupBy("session_id", (F.col("_cell") - 1).alias("_cell")).agg(F.min("_t").alias("_later"))
    upcoming = F.coalesce("_next", "_later")
    return (
        cells.withColumn("_next", F.lead("_t").over(order))
        .join(following, ["session_id", "_cell"], "left")
        .withColumn("reformulated", F.col("session_id").isNotNull() & F.coalesce(upcoming - F.col("_t") <= gap, F.lit(False)))
        .drop("_t", "_cell", "_next", "_later")
    )


def fold_clicks(events: DataFrame, clicks: DataFrame) -> DataFrame:
    """Distinct (event_id, product_id) clicks: those logged with the event and those added later.

    Long form on purpose: an event may collect any number of clicks.
    ``skew.nest_in_chunks`` turns it into arrays.
    """
    logged = events.select("event_id", F.explode("clicked").alias("product_id"))
    known = clicks.join(events.select("event_id"), "event_id", "left_semi")
    return logged.unionByName(known.select("event_id", "product_id")).distinct()


def distribution_shift(events: DataFrame, as_of, recent_days: int = 7, base_days: int = 90) -> DataFrame:
    """Share of each query condition now and before, for conditions present in both.

    Both ends of the base period count, so midnight ``recent_days`` ago is in both.
    """
    t = F.col("event_ts")
    is_now = t >= day(as_of, recent_days)
    is_base = (t >= day(as_of, base_days)) & (t <= day(as_of, recent_days))
    counts = (
        since(events, as_of, max(recent_days, base_days))
        .where(is_now | is_base)
        .groupBy("query_condition")
        .agg(F.count(F.when(is_now, 1)).alias("now"), F.count(F.when(is_base, 1)).alias("base"))
    )
    totals = counts.agg(F.struct(F.sum("now").alias("now"), F.sum("base").alias("base")).alias("t")).scalar()
    return (
        counts.where((F.col("now") > 0) & (F.col("base") > 0) & F.col("query_condition").isNotNull())
        .select(
            "query_condition",
            (F.col("now") / totals["now"]).alias("p_now"),
            (F.col("base") / totals["base"]).alias("p_base"),
        )
        .withColumn("shift", F.abs(F.col("p_now") - F.col("p_base")))
    )


def sync_record(index_name: str, vectors: DataFrame, synced_at) -> DataFrame:
    """One log row for an index sync."""
    return vectors.agg(
        F.lit(index_name).alias("index_name"),
        F.lit(synced_at).cast("timestamp").alias("synced_at"),
        F.count(F.lit(1)).alias("n_vectors"),
    )


def freshness(
    log: DataFrame, as_of, ts: str, by: list[str] | None = None, limits: Limits = Limits(), expected: DataFrame | None = None
) -> DataFrame:
    """Hours since the newest entry; over the limit is a warning, over four times high.

    ``expected`` has the ``by`` columns of all entries there should be; one that was never logged is reported as ``no_index``.
    """
    hours = F.col("hours")
    newest = log.groupBy(*(by or [])).agg(F.max(ts).alias("last_at"))
    if expected is not None:
        newest = expected.select(*by).distinct().join(newest, by, "left").unionByName(newest.join(expected, by, "left_anti"))
    return (
        newest
        .withColumn("hours", whole_hours("last_at", F.lit(as_of).cast("timestamp")))
        .withColumn("kind", F.when(F.col("last_at").isNull(), "no_index").otherwise("index_stale"))
        .withColumn(
            "severity",
            F.when(F.col("last_at").isNull(), "high")
            .when(hours > limits.max_stale_hours * 4, "high")
            .when(hours > limits.max_stale_hours, "warning"),
        )
    )


def coverage(products: DataFrame, embeddings: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Share of catalogue products that have a vector."""
    has = embeddings.select("product_id").distinct().withColumn("_has", F.lit(1))
    return (
        products.select("product_id")
        .join(has, "product_id", "left")
        .agg(F.count(F.lit(1)).alias("n_products"), F.count("_has").alias("n_embedded"))
        .withColumn("coverage", F.when(F.col("n_products") > 0, F.col("n_embedded") / F.col("n_products")).otherwise(0.0))
        .withColumn("severity", F.when(F.col("coverage") < limits.min_coverage, "high"))
    )


def latency_summary(events: DataFrame, by: list[str], budget_ms: float = 250.0) -> DataFrame:
    """Nearest-rank p50 and p95 per group, exact at any size, against the budget."""
    ranks = {
        "p50_ms": lambda n: F.floor(n / 2),
        "p95_ms": lambda n: F.floor(n * 0.95) - 1,
    }
    return select_ranks(events, by, "latency_ms", ranks).withColumn("within_budget", F.col("p95_ms") <= budget_ms)


def serving_checks(events: DataFrame, budget_ms: float = 250.0) -> DataFrame:
    """One latency check per day and model version over the logged searches."""
    daily = events.withColumn("checked_at", F.date_trunc("day", "event_ts"))
    return latency_summary(daily, ["checked_at", "model_version"], budget_ms).withColumn("budget_ms", F.lit(budget_ms))


def serving_history(checks: DataFrame, last: int = 10) -> DataFrame:
    """The newest serving checks."""
    return checks.orderBy(F.desc("checked_at"), "model_version").limit(last)


def recent_events(events: DataFrame, last: int = 20) -> DataFrame:
    """The newest searches with their click counts."""
    return (
        events.select(
            "event_id", "event_ts", "selected_category", "model_version", "n_results", "latency_ms",
            F.coalesce(F.size("clicked"), F.lit(0)).alias("n_clicks"),
        )
        .orderBy(F.desc("event_ts"), F.desc("event_id"))
        .limit(last)
    )


def _rules(measured: DataFrame, subject: str | None, *rules: tuple[Column | str, Column | str, str, Column]) -> DataFrame:
    """Fired rules ``(kind, severity, value, condition)`` over one measurement, in one pass."""
    lift = lambda c: F.lit(c) if isinstance(c, str) else c
    about = F.col(subject).cast("string") if subject else F.lit(None).cast("string")
    entries = [
        F.struct(
            lift(kind).alias("kind"), lift(severity).alias("severity"), F.col(value).cast("double").alias("value"),
            about.alias("subject"), F.coalesce(condition, F.lit(False)).alias("fired"),
        )
        for kind, severity, value, condition in rules
    ]
    return measured.select(F.inline(F.array(*entries))).where("fired").drop("fired")


def alerts(
    as_of,
    online: DataFrame | None = None,
    categories: DataFrame | None = None,
    shift: DataFrame | None = None,
    fresh: DataFrame | None = None,
    covered: DataFrame | None = None,
    trend: DataFrame | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """All rules over the measurements that are there; an absent one raises nothing.

    The measurements are aggregates, a handful of rows each.
    """
    severity = F.col("severity")
    parts: list[DataFrame] = []
    if online is not None:
        parts.append(_rules(
            online, None,
            ("low_ctr", "high", "ctr", F.col("ctr") < limits.min_ctr),
            ("zero_results", "high", "zero_result_rate", F.col("zero_result_rate") > limits.max_zero_rate),
            ("high_reformulation", "warning", "reformulation_rate", F.col("reformulation_rate") > limits.max_reformulation_rate),
            ("latency", "high", "p95_latency", F.col("p95_latency") > limits.max_p95_ms),
        ))
    if categories is not None:
        parts.append(_rules(categories, "category", ("category_ctr_low", "warning", "ctr", F.lit(True))))
    if shift is not None:
        shifted = F.col("shift") > limits.max_condition_shift
        parts.append(_rules(shift, "query_condition", ("query_distribution_drift", "warning", "shift", shifted)))
    if fresh is not None:
        subject = "index_name" if "index_name" in fresh.columns else None
        parts.append(_rules(fresh, subject, (F.col("kind"), severity, "hours", severity.isNotNull())))
    if covered is not None:
        parts.append(_rules(covered, None, ("incomplete_index", severity, "coverage", severity.isNotNull())))
    if trend is not None:
        newest = trend.groupBy("model_name").agg(F.max_by(F.struct("delta", "degraded"), "evaluated_at").alias("_l"))
        last = newest.select("model_name", "_l.*")
        parts.append(_rules(last, "model_name", ("champion_degraded", "high", "delta", F.col("degraded"))))
    if not parts:
        raise ValueError("no measurement given")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("payload", F.to_json(F.struct("kind", "severity", "value", "subject"))).withColumn(
        "raised_at", F.lit(as_of).cast("timestamp")
    )


def fail_on_high(raised: DataFrame) -> None:
    """Raise when any alert is high; only that one bit reaches the driver."""
    if raised.where(F.col("severity") == "high").limit(1).count():
        raise RuntimeError("high-severity alert raised")

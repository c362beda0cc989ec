"""Promotion gate over per-slice metrics, its history and its audit log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import PROMOTIONS, conform
from ..sources.snapshots import Conflict, Snapshots


@dataclass(frozen=True)
class GateConfig:
    max_drop_any_slice: float = 0.01
    max_drop_protected: float = 0.005
    min_queries: int = 20
    protected: tuple[tuple[str, str], ...] = field(default=(("category", "bag"), ("category", "hat")))
    overall_tolerance: float = 1e-9


def _verdict(name: str, passed: Column, observed: Column, threshold: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        passed.alias("passed"),
        observed.cast("double").alias("observed"),
        threshold.cast("double").alias("threshold"),
        detail.alias("detail"),
    )


def _overall(metric: str) -> Column:
    """Aggregate: the overall value of a metric, 0 when missing."""
    is_overall = (F.col("slice_dim") == "overall") & (F.col("slice_value") == "all")
    return F.coalesce(F.max(F.when(is_overall, F.col(metric))), F.lit(0.0))


def gate_verdicts(candidate: DataFrame, champion: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """Four verdicts: overall, any slice, protected slices, protected coverage.

    One pass: both metric tables (one row per slice) meet the protected list on
    the slice key and fold to a single row, from which the verdicts are read.
    A drop counts only when positive; the largest wins, ties go by name (by
    configured order among the protected slices).
    """
    keys = ["slice_dim", "slice_value"]
    protected = candidate.sparkSession.createDataFrame(
        [(d, v, i) for i, (d, v) in enumerate(cfg.protected)], "slice_dim string, slice_value string, position int"
    )
    is_new = candidate.select(*keys, "n_queries", "recall_at_20", "ndcg_at_20", F.lit(True).alias("_c"))
    is_old = champion.select(*keys, F.col("recall_at_20").alias("was"), F.col("ndcg_at_20").alias("ndcg_was"))
    slices = is_new.join(is_old, keys, "full").join(protected, keys, "full")

    label = F.concat_ws("=", *keys)
    drop = F.col("was") - F.col("recall_at_20")
    measurable = (F.col("slice_dim") != "overall") & (F.col("n_queries") >= cfg.min_queries)
    guarded = F.col("position").isNotNull()
    short = guarded & (F.coalesce(F.col("n_queries"), F.lit(0)) < cfg.min_queries)

    def worst(condition: Column, *tie: Column) -> Column:
        entry = F.struct((-drop).alias("gain"), *tie, label.alias("label"))
        return F.min(F.when(condition & (drop > 0), entry))

    # The protected list is configuration, so the collected labels are as few.
    folded = slices.agg(
        _overall("ndcg_at_20").alias("value"),
        _overall("ndcg_was").alias("bar"),
        worst(measurable).alias("any"),
        worst(guarded, F.col("position").alias("position")).alias("prot"),
        F.count(F.when(guarded, 1)).alias("total"),
        F.count(F.when(short, 1)).alias("missing"),
        F.array_sort(F.collect_list(F.when(short, F.struct("position", label.alias("label"))))).alias("which"),
    )

    def regression(name: str, entry: str, limit: float) -> Column:
        observed = F.coalesce(-F.col(f"{entry}.gain"), F.lit(0.0))
        detail = F.coalesce(F.concat(F.lit("worst: "), F.col(f"{entry}.label")), F.lit("no regression"))
        return _verdict(name, observed <= limit, observed, F.lit(limit), detail)

    verdicts = F.array(
        _verdict(
            "overall_ndcg20_not_worse", F.col("value") >= F.col("bar") - cfg.overall_tolerance,
            F.col("value"), F.col("bar"), F.lit("candidate vs champion"),
        ),
        regression("recall20_no_slice_regression", "any", cfg.max_drop_any_slice),
        regression("protected_slices_no_regression", "prot", cfg.max_drop_protected),
        _verdict(
            "protected_slice_coverage", F.col("missing") == 0, F.col("total") - F.col("missing"), F.col("total"),
            F.when(
                F.col("missing") > 0, F.concat(F.lit("too few queries: "), F.concat_ws(", ", "which.label"))
            ).otherwise("all covered"),
        ),
    )
    return folded.select(F.inline(verdicts))


def matryoshka_retention(short: DataFrame, full: DataFrame, floor: float = 0.95) -> DataFrame:
    """Does the truncated recall stage keep enough of the full Recall@50?"""
    whole = full.agg(_overall("recall_at_50").alias("full"))
    ratio = F.when(F.col("full") > 0, F.col("short") / F.col("full")).otherwise(0.0)
    verdict = _verdict(
        "truncated_recall_retained", ratio >= floor, ratio, F.lit(floor),
        F.lit("truncated Recall@50 as a fraction of full"),
    )
    return (
        short.agg(_overall("recall_at_50").alias("short"))
        .select("short", whole.scalar().alias("full"))
        .select(F.inline(F.array(verdict)))
    )


def gate_report(verdicts: DataFrame) -> DataFrame:
    """One row: passed, the failing checks by name, and a readable summary."""
    line = F.concat_ws(
        "; ",
        F.concat("name", F.when(F.col("passed"), " holds").otherwise(" FAILS")),
        F.format_string("measured %.4f, limit %.4f", "observed", "threshold"),
        "detail",
    )
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("name"))))
    report = verdicts.agg(
        F.bool_and("passed").alias("passed"),
        failed.alias("_failed"),
        F.array_sort(F.collect_list(line)).alias("_lines"),
    )
    names = F.concat_ws(", ", "_failed")
    return report.select(
        "passed",
        names.alias("failures"),
        F.concat_ws(
            "\n",
            F.when(F.col("passed"), F.lit("May be promoted.")).otherwise(F.concat(F.lit("Must not be promoted: "), names)),
            "_lines",
        ).alias("report"),
    )


def latest_metrics(history: DataFrame) -> DataFrame:
    """Rows of each model version's newest evaluation (a few slices per evaluation)."""
    newest = F.max("evaluated_at").over(Window.partitionBy("model_name", "model_version"))
    return history.withColumn("_newest", newest).where(F.col("evaluated_at") == F.col("_newest")).drop("_newest")


def champion_baseline(history: DataFrame, moves: DataFrame, model_name: str, alias: str, as_of) -> DataFrame:
    """Newest metrics of the version that held ``alias`` at ``as_of``; empty when none did."""
    holder = alias_asof(moves, as_of).where((F.col("model_name") == model_name) & (F.col("alias") == alias))
    return latest_metrics(history.where(F.col("model_name") == model_name)).join(
        holder.select(F.col("version").cast("string").alias("model_version")), "model_version", "left_semi"
    )


def alias_asof(moves: DataFrame, as_of) -> DataFrame:
    """Version holding each alias at a time, from the append-only move log."""
    seen = moves.where(F.col("moved_at") <= F.lit(as_of).cast("timestamp"))
    last = F.struct("moved_at", "version")
    return seen.groupBy("model_name", "alias").agg(
        F.max_by("version", last).alias("version"), F.max("moved_at").alias("moved_at")
    )


def latest_version(moves: DataFrame) -> DataFrame:
    """Highest and next version number per model."""
    return moves.groupBy("model_name").agg(
        F.max("version").alias("latest_version"), (F.max("version") + 1).alias("next_version")
    )


def metric_trend(history: DataFrame, improve: float = 0.005, degrade: float = 0.02) -> DataFrame:
    """Overall rows in time order with the change since the previous evaluation.

    One row per evaluation run of a model, so the window per model is short.
    """
    order = Window.partitionBy("model_name").orderBy("evaluated_at", "model_version")
    d = F.col("delta")
    return (
        history.where(F.col("slice_dim") == "overall")
        .withColumn("delta", F.col("ndcg_at_20") - F.lag("ndcg_at_20").over(order))
        .withColumn(
            "trend",
            F.when(d.isNull(), "first").when(d > improve, "improved").when(d < -improve, "declined").otherwise("held steady"),
        )
        .withColumn("degraded", F.coalesce(d < -degrade, F.lit(False)))
        .select(
            "model_name", "model_version", "evaluated_at", "n_queries",
            "recall_at_20", "ndcg_at_20", "mrr", "delta", "trend", "degraded",
        )
    )


def weak_slices(metrics: DataFrame, share: float = 0.85, min_queries: int = 20) -> DataFrame:
    """Slices whose rounded Recall@20 is below a share of the overall value.

    ``metrics`` is one evaluation, a row per slice, so one window over it is small.
    """
    overall = F.max(F.when(F.col("slice_dim") == "overall", F.col("recall_at_20"))).over(Window.partitionBy(F.lit(0)))
    rounded = F.round("recall_at_20", 3)
    return (
        metrics.withColumn("floor", overall * share)
        .where((F.col("slice_dim") != "overall") & (F.col("n_queries") >= min_queries) & (rounded < F.col("floor")))
        .select("slice_dim", "slice_value", "n_queries", rounded.alias("recall_at_20"), "floor")
    )


def promotion_log(promotions: DataFrame, last: int = 10) -> DataFrame:
    """The newest promotions; a version that failed its gate is refused."""
    return (
        promotions.where(F.col("gate_status") != "FAILED")
        .orderBy(F.desc("promoted_at"), F.desc("to_version"))
        .limit(last)
    )


def accepted(promotions: DataFrame) -> DataFrame:
    """Promotions that may be logged: a version that failed its gate is refused, and so is one without a verdict."""
    return promotions.where(F.col("gate_status").isin("PASSED", "FORCED"))


def promote(log: Snapshots, promotions: DataFrame, expected: int | None = None) -> int:
    """Append promotions to the log and return its new version.

    Refuses the whole call when one of them failed its gate. Who and when are the session's user and now, where they are
    missing. ``expected`` is the log version the decision was based
    on: if another promotion was logged since, nothing is written and ``Conflict`` is raised.
    """
    if promotions.join(accepted(promotions).select("model_name", "to_version"), ["model_name", "to_version"], "left_anti").limit(1).count():
        raise ValueError("a version that failed its gate cannot be promoted")
    signed = promotions.withColumns({
        "promoted_by": F.coalesce("promoted_by", F.current_user()), "promoted_at": F.coalesce("promoted_at", F.current_timestamp())
    })
    return log.append(conform(signed, PROMOTIONS), expected)


def fold_evaluation(
    history: Snapshots, evaluate: Callable[[], DataFrame], model_name: str, model_version: str, evaluated_at
) -> bool:
    """Add one evaluation (a row per slice) to the metric history, unless it is there already.

    Its key is (model, version, time). ``evaluate`` runs only when the key is new; its rows are read ever after.
    """
    at = F.lit(evaluated_at).cast("timestamp")
    while True:
        base = history.newest()
        if base:
            mine = (F.col("model_name") == model_name) & (F.col("model_version") == model_version) & (F.col("evaluated_at") == at)
            if history.read(base).where(mine).limit(1).count():
                return False
        rows = evaluate().select(
            "*", F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"), at.alias("evaluated_at")
        )
        try:
            history.append(rows.coalesce(1), base)  # a few dozen slices
            return True
        except Conflict:  # somebody else folded one in; look again whether it was this one
            continue

"""Has the input moved? Distribution distances between two sets of rows or counts.

Counts are ``(key, n)`` tables. A distance over nothing measured is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import vectors as V
from ..functions.scalars import delta_verdict, histogram_bin, js_verdict, psi_verdict


def counts_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))


def _aligned(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, b, a) over the union of keys; a key one side lacks counts 0 there."""
    stacked = before.select("key", F.col("n").alias("b"), F.lit(0).cast("bigint").alias("a")).unionByName(
        after.select("key", F.lit(0).cast("bigint").alias("b"), F.col("n").alias("a"))
    )
    return stacked.groupBy("key").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))


def _shares(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, e, a): shares of each key before and after."""
    aligned = _aligned(before, after)
    totals = aligned.agg(F.struct(F.sum("b").alias("b"), F.sum("a").alias("a")).alias("t")).scalar()
    share = lambda side: F.col(side) / F.when(totals[side] > 0, totals[side]).otherwise(1)
    return aligned.select("key", share("b").alias("e"), share("a").alias("a"))


def psi(expected: DataFrame, actual: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """Population stability index of two count tables, with its verdict; 0 without keys."""
    e, a = F.greatest("e", F.lit(epsilon)), F.greatest("a", F.lit(epsilon))
    return (
        _shares(expected, actual)
        .select(((a - e) * F.log(a / e)).alias("term"))
        .agg(F.coalesce(F.sum("term"), F.lit(0.0)).alias("psi"))
        .withColumn("verdict", psi_verdict("psi"))
    )


def js_distance(p: DataFrame, q: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (base 2, root of the divergence) of two count tables."""
    mid = F.greatest((F.col("e") + F.col("a")) / 2, F.lit(1e-12))

    def half(side: str) -> Column:
        x = F.col(side)
        return F.sum(F.when(x > 0, x * F.log2(x / mid)).otherwise(0.0)) / 2

    return (
        _shares(p, q)
        .agg(F.greatest(F.coalesce(half("e") + half("a"), F.lit(0.0)), F.lit(0.0)).alias("js"))
        .select(F.sqrt("js").alias("js"))
        .withColumn("verdict", js_verdict("js"))
    )


def histogram(values: DataFrame, column: str, bins: int = 20, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """(bin, n) for every bin, empty ones included; out-of-range values are ignored."""
    counted = (
        values.select(histogram_bin(column, bins, lo, hi).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def centroid_shift(before: DataFrame, after: DataFrame, vector: str = "embedding") -> DataFrame:
    """1 - cosine of the two mean vectors; NULL when a side is empty or its mean is zero."""
    b = V.mean_vector(before, vector).agg(F.first("centroid").alias("b"))
    a = V.mean_vector(after, vector).agg(F.first("centroid").alias("a"))
    return b.select("b", a.scalar().alias("a")).select((1 - V.cosine("b", "a")).alias("shift"))


def snapshot(
    products: DataFrame, queries: DataFrame, confidences: DataFrame, items: DataFrame
) -> DataFrame:
    """One long table of everything a later run compares against.

    Rows are ``(signal, key, value)``: counts per category, size band and
    confidence bin, the centroid by position, rates and table sizes.
    ``confidences`` has ``score``; ``items`` comes from ``expand_items`` or ``first_items``.
    """
    def rows(df: DataFrame, signal: str, key: str, value: str) -> DataFrame:
        return df.select(
            F.lit(signal).alias("signal"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value")
        )

    centroid = V.mean_vector(queries).select(F.posexplode("centroid").alias("key", "value"))
    first = items.where(F.col("item_index") == 0)
    rates = first.agg(
        F.avg(F.col("used_whole_image").cast("double")).alias("fallback_rate"),
    ).select(F.lit("all").alias("key"), F.round("fallback_rate", 4).alias("value"))
    mean = confidences.agg(F.avg("score").alias("value")).select(F.lit("all").alias("key"), "value")
    sizes = products.agg(F.count(F.lit(1)).alias("value")).select(F.lit("n_products").alias("key"), "value").unionByName(
        queries.agg(F.count(F.lit(1)).alias("value")).select(F.lit("n_eval_queries").alias("key"), "value")
    )
    parts = [
        rows(counts_by(products, "category"), "category_counts", "key", "n"),
        rows(counts_by(queries, "size_band"), "size_band_counts", "key", "n"),
        rows(histogram(confidences, "score"), "confidence_hist", "bin", "n"),
        rows(centroid, "centroid", "key", "value"),
        rows(rates, "fallback_rate", "key", "value"),
        rows(mean, "mean_confidence", "key", "value"),
        rows(sizes, "table_size", "key", "value"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def snapshot_payload(snap: DataFrame) -> DataFrame:
    """Snapshot as one JSON row per signal. A snapshot holds a few hundred rows by design."""
    return snap.groupBy("signal").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))).alias("payload")
    )


PAYLOAD = "signal string, values map<string, double>, _broken string"


def payloads(snap: DataFrame, captured_at, model_version: str) -> DataFrame:
    """A snapshot as log rows (captured_at, model_version, payload): one JSON document per signal."""
    values = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))
    return snap.groupBy("signal").agg(values.alias("values")).select(
        F.lit(captured_at).cast("timestamp").alias("captured_at"), F.lit(model_version).alias("model_version"),
        F.to_json(F.struct("signal", "values")).alias("payload"),
    )


def read_payloads(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): (captured_at, model_version, signal, key, value) of the payloads, and the log rows set aside.

    A payload is bad when it is null, is no JSON document of the declared schema, or names no signal.
    """
    parsed = log.withColumn("_p", F.from_json("payload", PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    good = F.coalesce(F.col("_p._broken").isNull() & F.col("_p.signal").isNotNull() & F.col("_p.values").isNotNull(), F.lit(False))
    rows = parsed.where(good).select("captured_at", "model_version", "_p.signal", F.explode("_p.values").alias("key", "value"))
    return rows, parsed.where(~good).drop("_p")


def newest_two(snapshots: DataFrame, at: str = "captured_at") -> tuple[DataFrame, DataFrame]:
    """(previous, current): the rows of the last two captures of a snapshot log.

    Only the capture times are ranked, and the two newest are found by a top-2
    instead of a sort. With a single capture the previous one is empty.
    """
    times = snapshots.select(at).distinct().orderBy(F.desc(at)).limit(2)
    bounds = times.agg(F.struct(F.max(at).alias("newest"), F.min(at).alias("oldest")).alias("t")).scalar()
    current = snapshots.where(F.col(at) == bounds["newest"])
    previous = snapshots.where((F.col(at) == bounds["oldest"]) & (bounds["oldest"] < bounds["newest"]))
    return previous, current


# What each stored signal is reported as, its measure, and the digits that are kept.
_REPORTED = [
    ("category_counts", "category_mix", "PSI", 4),
    ("size_band_counts", "query_size_bands", "PSI", 4),
    ("confidence_hist", "detector_confidence", "JS distance", 4),
    ("fallback_rate", "detector_fallback_rate", "absolute change", 4),
    ("mean_confidence", "mean_confidence", "absolute change", 4),
    ("centroid", "query_embedding_centroid", "cosine distance", 5),
]


def drift_report(previous: DataFrame, current: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """One row per signal both snapshots measured; a signal one side lacks has no row.

    Both snapshots are aligned once on (signal, key) and every measure is folded
    per signal in the same pass. A snapshot holds a few hundred rows by design.
    """
    keys = ["signal", "key"]
    nothing = F.lit(None).cast("double")
    aligned = (
        previous.select(*keys, F.col("value").alias("b"), nothing.alias("a"))
        .unionByName(current.select(*keys, nothing.alias("b"), F.col("value").alias("a")))
        .groupBy(*keys)
        .agg(F.max("b").alias("b"), F.max("a").alias("a"))
    )
    of_signal = Window.partitionBy("signal")
    shares = aligned.select(
        "*",
        *[F.coalesce(F.col(s) / F.nullif(F.sum(s).over(of_signal), F.lit(0.0)), F.lit(0.0)).alias(f"{s}_share") for s in "ba"],
    )
    e, x = F.greatest("b_share", F.lit(epsilon)), F.greatest("a_share", F.lit(epsilon))
    mid = F.greatest((F.col("b_share") + F.col("a_share")) / 2, F.lit(1e-12))
    kl = [F.sum(F.when(F.col(f"{s}_share") > 0, F.col(f"{s}_share") * F.log2(F.col(f"{s}_share") / mid)).otherwise(0.0)) for s in "ba"]
    measured = (
        shares.groupBy("signal")
        .agg(
            F.sum((x - e) * F.log(x / e)).alias("PSI"),
            F.sqrt(F.greatest((kl[0] + kl[1]) / 2, F.lit(0.0))).alias("JS distance"),
            (F.max("a") - F.max("b")).alias("absolute change"),
            (1 - F.sum(F.col("a") * F.col("b")) / F.nullif(F.sqrt(F.sum(F.col("a") * F.col("a")) * F.sum(F.col("b") * F.col("b"))), F.lit(0.0))).alias("cosine distance"),
            F.count("b").alias("nb"),
            F.count("a").alias("na"),
        )
        .where((F.col("nb") > 0) & (F.col("na") > 0))
    )
    verdicts = {
        "PSI": psi_verdict("PSI"),
        "JS distance": js_verdict("JS distance"),
        "detector_fallback_rate": delta_verdict("absolute change", 0.10),
        "mean_confidence": delta_verdict("absolute change", 0.05),
        "cosine distance": delta_verdict("cosine distance", 0.05),
    }
    entries = [
        F.struct(
            F.lit(source).alias("source"), F.lit(name).alias("signal"), F.lit(metric).alias("metric"),
            F.round(metric, digits).alias("value"), verdicts.get(name, verdicts.get(metric)).alias("verdict"),
        )
        for source, name, metric, digits in _REPORTED
    ]
    rows = measured.select(F.col("signal").alias("_of"), F.inline(F.array(*entries)))
    return rows.where((F.col("_of") == F.col("source")) & F.col("value").isNotNull()).drop("_of", "source")

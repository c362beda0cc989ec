"""Structured Streaming versions of the log operators.

The transformations take and return streaming DataFrames (most work on batch
ones too). ``run_to_table`` drives one over everything that is there now and
returns the written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..session import work_dir


def _rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def online_by_day(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Search metrics per tumbling day; rows later than the watermark are dropped."""
    return (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 day"))
        .agg(
            F.count(F.lit(1)).alias("n_searches"),
            _rate(F.size("clicked") > 0).alias("ctr"),
            _rate(F.col("n_results") == 0).alias("zero_result_rate"),
        )
        .select(F.col("window.start").alias("day"), "n_searches", "ctr", "zero_result_rate")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = "1 day") -> DataFrame:
    """Session windows per user: number of searches, start and end of the activity.

    Only a count and two extremes are kept per open session, however busy it is.
    """
    return (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.session_window("event_ts", gap).alias("w"), "session_id")
        .agg(F.count(F.lit(1)).alias("n_searches"), F.max("event_ts").alias("last_search"))
        .select(
            "session_id", F.col("w.start").alias("started"), "last_search", "n_searches",
            (F.col("n_searches") > 1).alias("searched_again"),
        )
    )


def searches_with_clicks(searches: DataFrame, clicks: DataFrame, within: str = "30 minutes", lateness: str = "1 day") -> DataFrame:
    """Left outer stream join of searches to the clicks that follow within a bound.

    ``clicks`` has ``event_id, product_id, click_ts``. The watermarks and the time
    bound let finished searches leave the state.
    """
    s = searches.withWatermark("event_ts", lateness).alias("s")
    c = clicks.withWatermark("click_ts", lateness).alias("c")
    condition = (
        (F.col("s.event_id") == F.col("c.event_id"))
        & (F.col("c.click_ts") >= F.col("s.event_ts"))
        & (F.col("c.click_ts") <= F.col("s.event_ts") + F.expr(f"INTERVAL {within}"))
    )
    return s.join(c, condition, "leftOuter").select(
        "s.event_id", "s.event_ts", F.col("c.product_id").alias("product_id"), "c.click_ts"
    )


def open_sessions(events: DataFrame, closed: DataFrame, gap: str = "30 minutes", lateness: str = "1 day") -> DataFrame:
    """Batch: the sessions of ``events`` that ``closed``, the sink of ``sessions``, does not have yet.

    Only users with a search past the watermark, less one gap, are read again, with all their searches.
    """
    mark = events.agg(F.max("event_ts") - F.expr(f"INTERVAL {lateness}") - F.expr(f"INTERVAL {gap}")).scalar()
    recent = events.where(F.col("event_ts") >= mark)
    users = recent.select(F.col("session_id").alias("_user")).distinct()
    again = sessions(events.join(users, F.col("session_id").eqNullSafe(F.col("_user")), "left_semi"), gap, lateness)
    had = closed.select(F.col("session_id").alias("_user"), F.col("started").alias("_started"))
    return again.join(had, F.col("session_id").eqNullSafe(F.col("_user")) & (F.col("started") == F.col("_started")), "left_anti")


def open_searches(searches: DataFrame, clicks: DataFrame, joined: DataFrame, within: str = "30 minutes", lateness: str = "1 day") -> DataFrame:
    """Batch: the searches, with clicks if any, that ``joined``, the sink of ``searches_with_clicks``, does not have yet.

    Without any click the watermark has not moved, so all searches are looked at.
    """
    newest = searches.agg(F.max("event_ts").alias("_s")).crossJoin(clicks.agg(F.max("click_ts").alias("_c")))
    # One second more than the bound; the anti-join drops what has come out.
    past = F.expr(f"event_ts >= least(_s, _c) - INTERVAL {lateness} - INTERVAL {within} - INTERVAL 1 second")
    recent = searches.crossJoin(F.broadcast(newest)).where(F.col("_c").isNull() | past).drop("_s", "_c")
    return searches_with_clicks(recent, clicks, within, lateness).join(joined.select("event_id"), "event_id", "left_anti")


def merge_sessions(parts: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Batch: pieces of sessions (session_id, started, last_search, n_searches) joined where they are within the gap.

    Pieces are sessions already, so a busy user brings a row per session and not one per search.
    """
    user = Window.partitionBy("session_id").orderBy("started", "last_search")
    before = F.max("last_search").over(user.rowsBetween(Window.unboundedPreceding, -1))
    apart = before.isNull() | (F.col("started") > before + F.expr(f"INTERVAL {gap}"))
    numbered = parts.withColumn("_apart", apart.cast("int")).withColumn("_nth", F.sum("_apart").over(user.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("session_id", "_nth").agg(
        F.min("started").alias("started"), F.max("last_search").alias("last_search"), F.sum("n_searches").alias("n_searches")
    ).drop("_nth")


SESSIONS = "session_id {id}, started timestamp, last_search timestamp, n_searches bigint, batch bigint"


def _folder(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table of batch folders; empty before the first one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def session_table(events: DataFrame, base: str, gap: str = "30 minutes") -> DataFrame:
    """Folds all events that a stream holds now into the session table below ``base``, and returns the table.

    Nothing is closed by a watermark: a search that comes late joins the sessions it lies between, in this run or a
    later one with the same ``base``. A micro-batch writes, under its id, all sessions of the users it has searches
    of; a user's rows of the newest batch count, so a replayed batch replaces its own output.
    """
    spark = events.sparkSession
    schema = StructType.fromDDL(SESSIONS.format(id=events.schema["session_id"].dataType.simpleString()))

    def fold(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.groupBy(F.session_window("event_ts", gap).alias("w"), "session_id").agg(
            F.count(F.lit(1)).alias("n_searches"), F.min("event_ts").alias("started"), F.max("event_ts").alias("last_search")
        ).select("session_id", "started", "last_search", "n_searches")
        users = batch.select(F.col("session_id").alias("_user")).distinct()
        known = _newest_of_user(_folder(spark, f"{base}/state", schema).where(F.col("batch") < batch_id))
        old = known.join(users, F.col("session_id").eqNullSafe(F.col("_user")), "left_semi")
        merge_sessions(old.unionByName(fresh), gap).write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")

    _drain(events, fold, f"{base}/checkpoint")
    done = _newest_of_user(_folder(spark, f"{base}/state", schema))
    return done.withColumn("searched_again", F.col("n_searches") > 1)


def _newest_of_user(state: DataFrame) -> DataFrame:
    newest = state.groupBy(F.col("session_id").alias("_user")).agg(F.max("batch").alias("_newest"))
    same = F.col("session_id").eqNullSafe(F.col("_user")) & (F.col("batch") == F.col("_newest"))
    return state.join(newest, same).drop("batch", "_user", "_newest")


def click_table(searches: DataFrame, clicks: DataFrame, base: str, within: str = "30 minutes") -> DataFrame:
    """Folds two streams into the tables below ``base`` and returns all searches with the clicks that follow in time.

    Searches and clicks are kept by day, so a micro-batch meets the rows of the days it can match only, however late
    it comes. Each micro-batch matches its searches with all clicks and the searches before it with its clicks.
    """
    spark = searches.sparkSession
    day = lambda ts: F.to_date(ts).alias("day")
    s = searches.select("event_id", "event_ts", F.lit(None).cast(clicks.schema["product_id"].dataType).alias("product_id"), F.lit(None).cast("timestamp").alias("click_ts"))
    c = clicks.select("event_id", F.lit(None).cast("timestamp").alias("event_ts"), "product_id", "click_ts")
    event_id, product_id = (d.schema[n].dataType.simpleString() for d, n in ((searches, "event_id"), (clicks, "product_id")))
    kinds = {
        "searches": f"event_id {event_id}, event_ts timestamp, batch bigint, day date",
        "clicks": f"event_id {event_id}, product_id {product_id}, click_ts timestamp, batch bigint, day date",
        "matches": f"event_id {event_id}, product_id {product_id}, click_ts timestamp, batch bigint",
    }
    reach = F.expr(f"INTERVAL {within}")

    def kept(kind: str) -> DataFrame:
        return _folder(spark, f"{base}/{kind}", kinds[kind])

    def matched(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(F.col("event_id").alias("_event"), "product_id", "click_ts")
        in_time = F.col("click_ts").between(F.col("event_ts"), F.col("event_ts") + reach)
        return left.join(right, (F.col("event_id") == F.col("_event")) & in_time).select("event_id", "product_id", "click_ts")

    def fold(batch: DataFrame, batch_id: int) -> None:
        batch.where("event_ts IS NOT NULL OR click_ts IS NULL").select("event_id", "event_ts", day("event_ts")).write.mode("overwrite").partitionBy("day").parquet(f"{base}/searches/batch={batch_id}")
        batch.where("click_ts IS NOT NULL").select("event_id", "product_id", "click_ts", day("click_ts")).write.mode("overwrite").partitionBy("day").parquet(f"{base}/clicks/batch={batch_id}")
        mine, theirs = kept("searches").where(F.col("batch") == batch_id), kept("clicks").where(F.col("batch") == batch_id)
        # Two dates a side reach the driver; they become partition filters.
        asked = mine.agg(F.min("day"), F.max(F.to_date(F.col("event_ts") + reach))).first()
        clicked = theirs.agg(F.min(F.to_date(F.col("click_ts") - reach)), F.max("day")).first()
        found = matched(mine, kept("clicks").where((F.col("batch") <= batch_id) & F.col("day").between(*map(F.lit, asked))))
        older = kept("searches").where((F.col("batch") < batch_id) & F.col("day").between(*map(F.lit, clicked)))
        found.unionByName(matched(older, theirs)).write.mode("overwrite").parquet(f"{base}/matches/batch={batch_id}")

    _drain(s.unionByName(c), fold, f"{base}/checkpoint")
    late = kept("matches").select(F.col("event_id").alias("_event"), "product_id", "click_ts")
    return kept("searches").join(late, F.col("event_id") == F.col("_event"), "left").select("event_id", "event_ts", "product_id", "click_ts")


def _drain(stream: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(fold).start().awaitTermination()


def once_per_event(events: DataFrame, lateness: str = "1 day", key: str = "event_id") -> DataFrame:
    """Drop repeated deliveries of an event within the watermark."""
    return events.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, name: str, output: str = "append") -> DataFrame:
    """Process all available input once and return the sink as a batch table.

    Append mode writes Parquet exactly once. In complete or update mode each
    micro-batch is written under its id, and the last write of a key counts.
    """
    spark = stream.sparkSession
    base = work_dir(spark, f"stream-{name}")
    sink, checkpoint = f"{base}/table", f"{base}/checkpoint"
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if output == "append":
        query = writer.outputMode("append").format("parquet").option("path", sink).start()
    else:
        def save(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

        query = writer.outputMode(output).foreachBatch(save).start()
    query.awaitTermination()
    return spark.read.schema(_sink_schema(stream, output)).parquet(sink)


def _sink_schema(stream: DataFrame, output: str) -> StructType:
    schema = StructType([*stream.schema.fields])
    return schema if output == "append" else schema.add("batch_id", LongType())


def latest_per_key(written: DataFrame, keys: list[str]) -> DataFrame:
    """Final state of an update-mode sink: per key, the row of the newest batch."""
    others = [c for c in written.columns if c not in (*keys, "batch_id")]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")


def sync_embeddings(
    arrivals: DataFrame,
    store: str,
    embed: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
    stored: StructType,
) -> None:
    """Triggered sync: embed only what the store lacks and append it.

    ``embed(items, existing)`` is ``infer.embed_incremental`` with its model bound;
    ``stored`` is the schema it returns. Each micro-batch owns one folder, so a
    replayed batch replaces its own output and nothing is added twice.
    """
    spark = arrivals.sparkSession
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def sync(batch: DataFrame, batch_id: int) -> None:
        known = read_store(spark, store, stored).where((F.col("run") != run) | (F.col("batch") < batch_id))
        fresh = embed(batch, known.drop("run", "batch"))
        fresh.write.mode("overwrite").parquet(f"{store}/run={run}/batch={batch_id}")

    (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sync)
        .start()
        .awaitTermination()
    )


def read_store(spark: SparkSession, store: str, stored: StructType) -> DataFrame:
    """All synced vectors with the run and batch that wrote them; empty at first."""
    schema = StructType([*stored.fields]).add("run", StringType()).add("batch", LongType())
    try:
        return spark.read.schema(schema).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

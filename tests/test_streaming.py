import pytest
from pyspark.sql import functions as F

from vitrine.operators import infer
from vitrine.plans.models import text_encoder
from vitrine.streaming import logs

COLUMNS = "event_id long, session_id string, clicked array<int>, n_results int"


def arrive(spark, folder, files):
    """Write one Parquet file per list of (event_id, time), in order, and stream them one per batch."""
    import time

    for n, rows in enumerate(files):
        df = spark.createDataFrame([(i, "s", [1] if i % 2 else [], 0 if i % 3 == 0 else 5, at) for i, at in rows], COLUMNS + ", at string")
        df.withColumn("event_ts", F.col("at").cast("timestamp")).drop("at").coalesce(1).write.mode("append").parquet(f"{folder}/part{n}")
        time.sleep(0.05)
    schema = spark.read.parquet(f"{folder}/part0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def test_days_equal_batch_and_late_rows_are_dropped(spark, tmp_path):
    files = [
        [(1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")],
        [(3, "2024-01-01 23:00:00"), (4, "2024-01-05 01:00:00")],
        [(5, "2024-01-05 02:00:00")],
        [(6, "2024-01-01 03:00:00"), (7, "2024-01-05 03:00:00")],
    ]
    written = logs.run_to_table(logs.online_by_day(arrive(spark, str(tmp_path), files), "1 day"), "days", "update")
    got = {str(r["day"])[:10]: (r["n_searches"], r["ctr"]) for r in logs.latest_per_key(written, ["day"]).collect()}
    assert got == {"2024-01-01": (3, pytest.approx(2 / 3)), "2024-01-05": (3, pytest.approx(2 / 3))}


def test_repeated_event_is_kept_once_across_batches(spark, tmp_path):
    files = [[(1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")], [(1, "2024-01-01 01:00:00"), (3, "2024-01-01 03:00:00")]]
    once = logs.run_to_table(logs.once_per_event(arrive(spark, str(tmp_path), files)), "once")
    assert sorted(r["event_id"] for r in once.collect()) == [1, 2, 3]


def test_sessions_close_after_the_gap(spark, tmp_path):
    files = [[(1, "2024-01-01 01:00:00"), (2, "2024-01-01 01:20:00"), (3, "2024-01-01 03:00:00")], [(4, "2024-01-02 12:00:00")]]
    closed = logs.run_to_table(logs.sessions(arrive(spark, str(tmp_path), files), lateness="1 hour"), "sessions").collect()
    assert sorted((r["n_searches"], r["searched_again"]) for r in closed) == [(1, False), (2, True)]


def test_open_sessions_complete_the_closed_ones(spark, tmp_path):
    files = [[(1, "2024-01-01 01:00:00"), (2, "2024-01-01 01:20:00"), (3, "2024-01-01 03:00:00")], [(4, "2024-01-02 12:00:00")]]
    stream = arrive(spark, str(tmp_path), files)
    closed = logs.run_to_table(logs.sessions(stream, lateness="1 hour"), "sessions")
    events = spark.read.parquet(*(str(tmp_path / f"part{n}") for n in range(2)))
    whole = closed.unionByName(logs.open_sessions(events, closed, lateness="1 hour")).collect()
    assert sorted((str(r["started"]), r["n_searches"]) for r in whole) == [("2024-01-01 01:00:00", 2), ("2024-01-01 03:00:00", 1), ("2024-01-02 12:00:00", 1)]


def test_open_searches_complete_the_settled_ones(spark, tmp_path):
    folders = [str(tmp_path / x) for x in "sc"]
    searches = arrive(spark, folders[0], [[(1, "2024-01-01 01:00:00"), (2, "2024-01-01 01:00:00")], [(3, "2024-01-03 01:00:00"), (4, "2024-01-03 00:30:00")]])
    clicks = arrive(spark, folders[1], [[(1, "2024-01-01 01:10:00")], [(4, "2024-01-03 00:40:00")]])
    both = [(searches, clicks), [spark.read.parquet(f"{f}/part0", f"{f}/part1") for f in folders]]
    (s, c), (all_s, all_c) = ((x.select("event_id", "event_ts"), y.select("event_id", F.lit(5).alias("product_id"), F.col("event_ts").alias("click_ts"))) for x, y in both)
    joined = logs.run_to_table(logs.searches_with_clicks(s, c, lateness="1 hour"), "clicks")
    whole = joined.unionByName(logs.open_searches(all_s, all_c, joined, lateness="1 hour")).collect()
    assert sorted((r["event_id"], r["product_id"]) for r in whole) == [(1, 5), (2, None), (3, None), (4, 5)]
    # Without clicks nothing has come out of the stream yet.
    none = logs.open_searches(all_s, all_c.limit(0), joined.limit(0), lateness="1 hour").collect()
    assert sorted((r["event_id"], r["product_id"]) for r in none) == [(1, None), (2, None), (3, None), (4, None)]


def test_search_without_click_appears_after_its_time(spark, tmp_path):
    searches = arrive(spark, str(tmp_path / "s"), [[(1, "2024-01-01 01:00:00"), (2, "2024-01-01 01:00:00")], [(3, "2024-01-03 01:00:00")]])
    clicks = arrive(spark, str(tmp_path / "c"), [[(1, "2024-01-01 01:10:00"), (2, "2024-01-01 02:00:00")], [(4, "2024-01-03 01:00:00")]]).select(
        "event_id", F.lit(5).alias("product_id"), F.col("event_ts").alias("click_ts")
    )
    joined = logs.run_to_table(logs.searches_with_clicks(searches.select("event_id", "event_ts"), clicks, lateness="1 hour"), "clicks")
    assert sorted((r["event_id"], r["product_id"]) for r in joined.collect()) == [(1, 5), (2, None)]


def test_sync_twice_adds_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(n, f"word{n} shoe") for n in range(20)], "doc_id int, text string")
    docs.where("doc_id < 12").write.parquet(str(tmp_path / "docs/a"))
    stored = spark.createDataFrame([], "doc_id int, embedding array<double>, encoder_uri string").schema
    embed = lambda items, known: infer.embed_incremental(items, known, text_encoder, "bow", "doc_id", ["text"])
    store = str(tmp_path / "store")

    def sync(checkpoint):
        arrivals = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "docs/*"))
        logs.sync_embeddings(arrivals, store, embed, str(tmp_path / checkpoint), stored)
        return logs.read_store(spark, store, stored).count()

    assert logs.read_store(spark, store, stored).count() == 0
    assert sync("c1") == 12
    assert sync("c2") == 12
    docs.where("doc_id >= 12").write.parquet(str(tmp_path / "docs/b"))
    assert sync("c1") == 20
    assert logs.read_store(spark, store, stored).select("doc_id").distinct().count() == 20


def test_session_table_takes_late_rows(spark, tmp_path):
    """Three deliveries, the last ones late: one joins two old sessions, one user is new, one is null."""
    rows = [("a", "10:00"), ("a", "11:00"), ("b", "10:00"), (None, "10:00"), (None, "10:10")], [("c", "23:00"), ("a", "22:00")], [("a", "10:30"), ("a", "09:00"), ("d", "08:00")]
    base, got = str(tmp_path / "base"), None
    for n, part in enumerate(rows):
        spark.createDataFrame([(u, f"2024-01-01 {t}:00") for u, t in part], "session_id string, ts string").withColumn(
            "event_ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{n}"))
        stream = spark.readStream.schema("session_id string, ts string, event_ts timestamp").parquet(str(tmp_path / "in" / "part*"))
        got = logs.session_table(stream, base)
    found = {(r["session_id"], r["started"].strftime("%H:%M"), r["last_search"].strftime("%H:%M"), r["n_searches"]) for r in got.collect()}
    assert found == {
        ("a", "09:00", "09:00", 1), ("a", "10:00", "11:00", 3), ("a", "22:00", "22:00", 1), ("b", "10:00", "10:00", 1),
        (None, "10:00", "10:10", 2), ("c", "23:00", "23:00", 1), ("d", "08:00", "08:00", 1),
    }


def test_click_table_takes_late_rows(spark, tmp_path):
    """A click long after newer ones, a search after its click, one too late for the bound and one across midnight."""
    searches = [(1, "2024-01-01 10:00"), (2, "2024-01-01 23:50")], [(3, "2024-01-05 10:00")], [(4, "2024-01-01 12:00")]
    clicks = [(3, 30, "2024-01-05 10:05")], [(2, 20, "2024-01-02 00:10"), (4, 40, "2024-01-01 12:20")], [(1, 10, "2024-01-01 10:30"), (1, 11, "2024-01-01 10:31")]
    base, got = str(tmp_path / "base"), None
    for n in range(3):
        spark.createDataFrame(searches[n], "event_id long, t string").select("event_id", F.to_timestamp("t").alias("event_ts")).coalesce(1).write.parquet(str(tmp_path / "s" / f"part{n}"))
        spark.createDataFrame(clicks[n], "event_id long, product_id long, t string").select("event_id", "product_id", F.to_timestamp("t").alias("click_ts")).coalesce(1).write.parquet(str(tmp_path / "c" / f"part{n}"))
        s = spark.readStream.schema("event_id long, event_ts timestamp").parquet(str(tmp_path / "s" / "part*"))
        c = spark.readStream.schema("event_id long, product_id long, click_ts timestamp").parquet(str(tmp_path / "c" / "part*"))
        got = logs.click_table(s, c, base)
    assert sorted((r["event_id"], r["product_id"]) for r in got.collect()) == [(1, 10), (2, 20), (3, 30), (4, 40)]

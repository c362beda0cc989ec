"""Registered streaming queries: each processes everything the table holds now."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import work_dir
from ..streaming import changes, logs
from .inference import _CHECK, _BOW, ENCODER, _checked, _embed
from .inputs import EVENT_COLUMNS, Inputs
from .registry import query, rounded, text_time


def table_stream(i: Inputs, name: str) -> DataFrame:
    # As a glob, since a plain stream path must be a folder and a table may be one file.
    return i.spark.readStream.schema(i.raw(name).schema).parquet(f"{i.sf_dir}/{name}[.]parquet")


def event_stream(i: Inputs) -> DataFrame:
    # A stream takes the number of products as a value, read once.
    n = i.raw("part").agg(F.max("p_partkey") + 1).first()[0]
    return table_stream(i, "events").withColumn("_n", F.lit(n)).selectExpr(*EVENT_COLUMNS)


@query(
    "stream_online",
    """
SELECT strftime(date_trunc('day', event_ts), '%Y-%m-%d %H:%M:%S') AS day, count(*) AS n_searches, round(avg((len(clicked) > 0)::INT), 6) AS ctr,
       round(avg((n_results = 0)::INT), 6) AS zero_result_rate
FROM f_events GROUP BY 1""",
)
def stream_online(i):
    written = logs.run_to_table(logs.online_by_day(event_stream(i)), "online", "update")
    days = logs.latest_per_key(written, ["day"])
    return rounded(text_time(days, "day"), "ctr", "zero_result_rate")


@query(
    "stream_sessions",
    """
WITH marked AS (
  SELECT session_id, event_ts, (event_ts >= lag(event_ts) OVER w + INTERVAL 30 MINUTE) IS NOT FALSE AS starts
  FROM f_events WINDOW w AS (PARTITION BY session_id ORDER BY event_ts)),
numbered AS (SELECT *, sum(starts::INT) OVER (PARTITION BY session_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS nth FROM marked),
s AS (SELECT session_id, min(event_ts) AS started, max(event_ts) AS last_search, count(*) AS n_searches FROM numbered GROUP BY session_id, nth)
SELECT session_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, strftime(last_search, '%Y-%m-%d %H:%M:%S') AS last_search, n_searches,
       n_searches > 1 AS searched_again
FROM s""",
)
def stream_sessions(i):
    """All sessions, the open ones as well: the state is a table, and no row is too late for it."""
    table = logs.session_table(event_stream(i), work_dir(i.spark, "stream-sessions"))
    return text_time(table, "started", "last_search")


@query(
    "stream_clicks",
    """
SELECT s.event_id, strftime(s.event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, c.product_id, strftime(c.click_ts, '%Y-%m-%d %H:%M:%S') AS click_ts
FROM f_events s LEFT JOIN f_later_clicks c USING (event_id)""",
)
def stream_clicks(i):
    """All searches with their later clicks."""
    clicks = event_stream(i).where("n_results > 1").selectExpr(
        "event_id", "element_at(results_shown, 2) AS product_id", "event_ts + INTERVAL 4 MINUTES AS click_ts"
    )
    table = logs.click_table(event_stream(i).select("event_id", "event_ts"), clicks, work_dir(i.spark, "stream-clicks"))
    return text_time(table, "event_ts", "click_ts")


@query(
    "stream_sessions_whole",
    """
WITH marked AS (
  SELECT session_id, event_ts, (event_ts >= lag(event_ts) OVER w + INTERVAL 30 MINUTE) IS NOT FALSE AS starts
  FROM f_events WINDOW w AS (PARTITION BY session_id ORDER BY event_ts)),
numbered AS (SELECT *, sum(starts::INT) OVER (PARTITION BY session_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS nth FROM marked),
s AS (SELECT session_id, min(event_ts) AS started, max(event_ts) AS last_search, count(*) AS n_searches FROM numbered GROUP BY session_id, nth)
SELECT session_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, strftime(last_search, '%Y-%m-%d %H:%M:%S') AS last_search, n_searches,
       n_searches > 1 AS searched_again
FROM s""",
)
def stream_sessions_whole(i):
    """The same by a watermark: sessions that it has closed, and those still open by the batch form."""
    closed = logs.run_to_table(logs.sessions(event_stream(i), lateness="2 hours"), "sessions")
    return text_time(closed.unionByName(logs.open_sessions(i.events(), closed, lateness="2 hours")), "started", "last_search")


@query(
    "stream_clicks_whole",
    """
SELECT s.event_id, strftime(s.event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, c.product_id, strftime(c.click_ts, '%Y-%m-%d %H:%M:%S') AS click_ts
FROM f_events s LEFT JOIN f_later_clicks c USING (event_id)""",
)
def stream_clicks_whole(i):
    """The same by watermarks: searches that the stream has settled, and the youngest ones by the batch form."""
    later = ("event_id", "element_at(results_shown, 2) AS product_id", "event_ts + INTERVAL 4 MINUTES AS click_ts")
    sides = [(e.select("event_id", "event_ts"), e.where("n_results > 1").selectExpr(*later)) for e in (event_stream(i), i.events())]
    joined = logs.run_to_table(logs.searches_with_clicks(*sides[0], lateness="2 hours"), "clicks")
    return text_time(joined.unionByName(logs.open_searches(*sides[1], joined, lateness="2 hours")), "event_ts", "click_ts")


@query("stream_dedup", "SELECT event_id, session_id, n_results FROM f_events")
def stream_dedup(i):
    """Every event is delivered twice and kept once."""
    twice = event_stream(i).unionByName(event_stream(i))
    return logs.run_to_table(logs.once_per_event(twice), "dedup").select("event_id", "session_id", "n_results")


@query("stream_sync", f"SELECT doc_id, '{ENCODER}' AS encoder_uri, {_CHECK} FROM ({_BOW}) b")
def stream_sync(i):
    """Two triggered syncs over the same documents; the second finds nothing to do."""
    documents = i.raw("documents")
    stored = _embed(documents, i.stored_documents()).schema
    base = work_dir(i.spark, "sync")
    for run in ("first", "second"):
        arrivals = table_stream(i, "documents")
        logs.sync_embeddings(arrivals, f"{base}/store", _embed, f"{base}/checkpoint-{run}", stored)
    return _checked(logs.read_store(i.spark, f"{base}/store", stored).drop("run", "batch"))


_FINAL = """
SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 4 WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS seq,
       CASE WHEN doc_id % 10 = 0 THEN 'restored ' || text WHEN doc_id % 3 = 0 THEN text || ' again' ELSE text END AS text
FROM documents WHERE doc_id % 10 = 0 OR doc_id % 5 <> 0"""


@query(
    "stream_changes",
    f"""
WITH final AS ({_FINAL})
SELECT doc_id, '{ENCODER}' AS encoder_uri, seq::BIGINT AS seq, {_CHECK} FROM ({_BOW.replace("documents", "final")}) b JOIN final USING (doc_id)""",
)
def stream_changes(i):
    """Every document inserted, then some restored before their delete and some updated, each delivery a run of its own.

    The deliveries come out of order: a restored document is known when its delete arrives, a deleted one when its older update does.
    """
    documents = i.raw("documents")
    deliveries = [
        [("true", 1, "upsert", "text")],
        [("doc_id % 10 = 0", 4, "upsert", "concat('restored ', text)"), ("doc_id % 5 = 0", 3, "delete", "cast(NULL AS string)")],
        [("doc_id % 3 = 0", 2, "upsert", "concat(text, ' again')")],
    ]
    base = work_dir(i.spark, "changes")
    nothing = i.stored_documents().limit(0)
    embedded = _embed(documents, nothing).schema
    for n, delivery in enumerate(deliveries):
        for m, (rows, seq, op, text) in enumerate(delivery):
            delivered = documents.where(rows).selectExpr("doc_id", f"cast({seq} AS bigint) AS seq", f"'{op}' AS op", f"{text} AS text")
            delivered.write.parquet(f"{base}/in/{n}-{m}")
        stream = i.spark.readStream.schema(delivered.schema).parquet(f"{base}/in/*")
        table = changes.apply_changes(stream, f"{base}/table", lambda items: _embed(items, nothing), embedded, "doc_id")
    return _checked(table)

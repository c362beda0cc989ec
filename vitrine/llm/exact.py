"""Exact duplicates with the heavy hitters split off. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

#: ASCII white space, the characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Most digests that are treated as heavy, and counters that the frequent-item sketch keeps. They bound the
#: broadcast and the sketch, not the result: a digest that is not among them goes through the shuffle.
HEAVY = 1000
TRACKED = 20_000


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of texts that are identical after all ASCII white space is deleted.

    One row per input row: ``id_col``, ``keep_id`` (the id that stays), ``group_size``,
    ``kept`` and ``text_sha256`` (hex digest of the normalised text).

    The longest original text (in code points) stays, then the smallest id, a null id last.
    A null text is an empty text; all empty texts are one group. Of rows that agree
    in id and text exactly one is kept. Other columns are not read, so their names cannot clash.
    An empty table gives an empty result.

    Texts are read once and reduced to digests. A frequent-item sketch (Misra-Gries
    counters, merged from all tasks) names digests that may be frequent; their
    exact counts and winners come from a partial aggregate, at most ``HEAVY`` rows, and are broadcast, so
    that rows of large groups never move. All other digests are shuffled; the sketch bounds the size of those
    groups to a small share of all rows.
    """
    length = F.length(F.coalesce(F.col(text_col), F.lit("")))
    norm = F.translate(F.coalesce(F.col(text_col), F.lit("")), BLANKS, "")
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            F.sha2(norm, 256).alias("text_sha256"),
            F.struct(
                (-length).alias("l"), F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"),
                F.monotonically_increasing_id().alias("r"),
            ).alias("_rank"),
        ),
        "digests",
    )
    frequent = rows.agg(F.expr(f"approx_top_k(text_sha256, {HEAVY}, {TRACKED})").alias("top"))
    names = frequent.select(F.explode(F.col("top.item")).alias("text_sha256")).where("text_sha256 IS NOT NULL")
    verified = (
        rows.join(F.broadcast(names), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min("_rank").alias("_best"), F.count(F.lit(1)).alias("group_size"))
    )
    winners = stored(verified, "winners")
    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").withColumns(
        {"_best": F.min("_rank").over(group), "group_size": F.count(F.lit(1)).over(group)}
    )
    return heavy.unionByName(rest).select(
        F.col("_id").alias(id_col),
        F.col("_best.i").alias("keep_id"),
        "group_size",
        (F.col("_rank.r") == F.col("_best.r")).alias("kept"),
        "text_sha256",
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
),
r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER w = 1 AS kept
  FROM t
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""

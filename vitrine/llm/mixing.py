"""Mixing sources to target weights: random keys, range sort, running sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import running_sum, stored

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source gives more than this many times its own size.
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size): ``source``, ``source_size``, ``start`` (sizes of earlier sources), ``target``.

    Sources take turns in ``weights`` by code point, null last, and share the sum of
    all sizes. A source whose share passes ``max_epochs`` times its size stops there, and
    its excess is shared again by weight until none is above. Each round is one
    aggregate to one row; only that row reaches the driver, and every round stops at least one more source.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_sum(sources, order, F.lit(1), "source-rank").withColumnRenamed("before", "_rank")
    placed = running_sum(ranked, order, F.col("source_size"), "source-start").withColumnRenamed("before", "start")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = stored(
        placed.select("source", "source_size", "start", turn.cast("long").alias("_w"), (F.col("source_size") * max_epochs).alias("_cap")),
        "sources",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = F.lit(None).cast("double"), -1
    above = F.lit(False)
    while True:
        fixed, open_weight, n = table.agg(
            F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_w"))), F.count_if(above)
        ).first()
        if n == stopped or open_weight is None:
            break
        stopped, left = n, float(total - (fixed or 0))
        share = F.col("_w") * F.lit(left) / F.lit(float(open_weight))
        above = F.col("_cap") < share
    target = F.least(F.col("_cap").cast("double"), F.coalesce(share, F.col("_cap").cast("double")))
    return table.select("source", "source_size", "start", F.when(above, F.col("_cap").cast("double")).otherwise(target).alias("target"))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
    weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """What the mix takes of every row: ``_row``, ``_hash`` (of the text), id, ``source``, ``size``, ``source_size``, ``target``, ``epochs``, ``rest``, ``taken``.

    Inside a source the rows are ordered by a hash-random key of (seed, id), so
    reruns agree. Words are counted along that order: whole ``epochs`` of the source, then the ``rest`` of
    the budget, which ends inside one row; ``taken = epochs * size + rest``.

    Null texts have size 0, a null source is a source of its own, null ids are ordered as one id. Rows equal
    in id and size are interchangeable. Empty tables, and tables without any word, give targets of 0.
    The result depends on the rows only, not on their partitions.
    """
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15), 16, 10)
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
            F.xxhash64(text_col).alias("_hash"), word_count(F.col(text_col)).alias("size"), key.cast("long").alias("_key"),
        ),
        "mix-rows",
    )
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    order = [F.col("source").isNull(), F.col("source"), F.col("_key"), F.col("_id"), F.col("size"), F.col("_hash")]
    placed = running_sum(rows, order, F.col("size"), "mix-order")
    s = sources.withColumnRenamed("source", "_source")
    budget = F.floor("target").cast("long")
    before = F.col("before") - F.col("start")
    per = F.when(F.col("source_size") > 0, F.col("source_size"))
    return (
        placed.join(s, placed["source"].eqNullSafe(s["_source"]))
        .withColumn("epochs", F.coalesce(F.floor(budget / per).cast("long"), F.lit(0)))
        .withColumn("_left", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("rest", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - before)))
        .select(
            "_row", "_hash", F.col("_id").alias(id_col), "source", "size", "source_size", "target", "epochs", "rest",
            (F.col("epochs") * F.col("size") + F.col("rest")).alias("taken"),
        )
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, repeated per epoch.

    A row of which only ``rest`` words fit into the last epoch is cut after that word; that is at most one row
    per source. Rows of which no word is taken, and rows without words, do not appear. ``n_chars`` follows the
    text where the table has it. Rows are found again by id and text hash, repeated ones by their number, so null and
    repeated ids are as good as others.
    """
    same = Window.partitionBy("_mix_id", "_mix_hash").orderBy(F.desc("_mix_take"), F.desc("_mix_rest"))
    plan = mix_plan(docs, id_col, text_col, source_col, **options).select(
        F.col(id_col).alias("_mix_id"), F.col("_hash").alias("_mix_hash"), F.col("size").alias("_mix_size"),
        F.col("epochs").alias("_mix_epochs"), F.col("rest").alias("_mix_rest"), F.col("taken").alias("_mix_take"),
    )
    plan = plan.withColumn("_mix_number", F.row_number().over(same)).where("_mix_take > 0").drop("_mix_take")
    tagged = docs.select(F.struct("*").alias("_all"), F.col(id_col).alias("_by"), F.xxhash64(text_col).alias("_by_hash"))
    tagged = tagged.withColumn("_by_number", F.row_number().over(Window.partitionBy("_by", "_by_hash").orderBy(F.lit(0))))
    found = F.col("_by").eqNullSafe(F.col("_mix_id")) & (F.col("_by_hash") == F.col("_mix_hash")) & (F.col("_by_number") == F.col("_mix_number"))
    # One length per copy: whole copies, and a last one that may be shorter.
    last = F.when(F.col("_mix_rest") > 0, F.array("_mix_rest")).otherwise(F.array().cast("array<bigint>"))
    lengths = F.concat(last, F.array_repeat("_mix_size", F.col("_mix_epochs").cast("int")))
    copies = tagged.join(plan, found).select("_all", "_mix_size", F.explode(lengths).alias("_mix_take"))
    text = F.col("_all")[text_col]
    whole = F.col("_mix_take") >= F.col("_mix_size")
    parts = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    head = F.array_join(F.slice(parts, F.lit(1), F.col("_mix_take").cast("int")), "")
    changed = {text_col: F.when(whole, text).otherwise(head)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(whole, F.col("_all")["n_chars"]).otherwise(F.length(changed[text_col]).cast(docs.schema["n_chars"].dataType))
    return copies.select(*[changed.get(c, F.col("_all")[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH r AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (ARRAY[5, 2, 1])[((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM r GROUP BY source
),
o AS (  -- the sources that stop are those with the smallest cap by weight
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER ())::BIGINT AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS fixed,
         (sum(w) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open_weight
  FROM s
),
l AS (
  SELECT (total - fixed)::DOUBLE AS left_over, open_weight::DOUBLE AS open_weight FROM o
  WHERE cap >= w * (total - fixed)::DOUBLE / open_weight
  ORDER BY open_weight DESC LIMIT 1
),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, w * left_over / l.open_weight) AS target FROM o, l
),
p AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS taken
FROM p
"""

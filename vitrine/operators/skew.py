"""Building blocks that keep hot keys from landing in a single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

SMALL_TABLE_ROWS = 10_000


def fetch_if_small(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """A per-key side table, ready to join: broadcast when it is tiny.

    At most ``limit + 1`` rows are fetched to check its size. Within the bound the
    rows come back as a local table marked for broadcast, so joining them does
    not shuffle the other side; beyond it the join is left to the optimizer
    (shuffled, with adaptive skew splitting).
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def rank_in_groups(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str = "rank"
) -> DataFrame:
    """1-based row number within ``keys``, exact, for groups of any size.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside
    (keys, bucket) and shifted by the sizes of the earlier buckets, so a hot key
    is spread over its buckets instead of being sorted by one task.
    """
    tagged = df.withColumn("_bucket", bucket)
    part = [*keys, "_bucket"]
    offsets = (
        tagged.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    local = tagged.withColumn("_row", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    # Null keys and null buckets keep their rows.
    named = offsets.withColumnsRenamed({c: f"_of_{c}" for c in part})
    return (
        local.join(named, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in part])
        .withColumn(name, (F.col("_row") + F.col("_offset")).cast("int"))
        .drop("_row", "_offset", "_bucket", *[f"_of_{c}" for c in part])
    )


def value_at_rank(
    df: DataFrame,
    keys: list[str],
    value: str,
    targets: dict[str, Callable[[Column], Column]],
    width: float = 1.0,
) -> DataFrame:
    """Exact order statistics per group, one column per target plus ``n``.

    Each target maps the group size to a 0-based position in ascending order.
    Rows are first folded to (value, count); a coarse histogram of ``width``
    wide cells locates the cell of every position and only the values of those
    cells are looked at again.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_cell", F.floor(F.col(value) / width))
    running = Window.partitionBy(*keys).orderBy("_cell")
    cells = (
        counts.groupBy(*keys, "_cell")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n", F.sum("_n").over(Window.partitionBy(*keys)))
    )
    positions = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.greatest(fn(F.col("n")).cast("bigint"), F.lit(0)).alias("pos"))
            for name, fn in targets.items()
        ]
    )
    wanted = (
        cells.withColumn("_t", F.explode(positions))
        .where((F.col("_upto") - F.col("_n") <= F.col("_t.pos")) & (F.col("_t.pos") < F.col("_upto")))
        .select(
            *keys, "_cell", "n",
            F.col("_t.name").alias("_target"),
            (F.col("_t.pos") - (F.col("_upto") - F.col("_n"))).alias("_within"),
        )
    )
    place = [*keys, "_cell"]
    named = wanted.withColumnsRenamed({c: f"_of_{c}" for c in place})
    found = counts.join(named, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in place])
    inside = found.withColumn(
        "_cum",
        F.sum("_n").over(
            Window.partitionBy(*keys, "_target").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    reached = F.col("_cum") > F.col("_within")
    return inside.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.min(F.when(reached & (F.col("_target") == name), F.col(value))).alias(name)
            for name in targets
        ],
    )


def nest_in_chunks(
    df: DataFrame, keys: list[str], value: str, name: str, chunk_rows: int = 1024
) -> DataFrame:
    """Sorted arrays of the distinct values per group, in chunks of about ``chunk_rows``.

    Nearly every group fits chunk 0; a group of any size still gets all of its
    values, spread over several bounded rows instead of one unbounded array.
    """
    distinct = df.select(*keys, value).distinct()
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    chunk = F.pmod(F.xxhash64(F.col(value)), F.ceil(F.col("_n") / chunk_rows)).cast("int")
    return (
        distinct.join(sizes, keys)
        .withColumn("chunk", chunk)
        .groupBy(*keys, "chunk")
        .agg(F.sort_array(F.collect_list(value)).alias(name))
    )


def select_ranks(
    df: DataFrame,
    keys: list[str],
    value: str,
    targets: dict[str, Callable[[Column], Column]],
    cells: int = 1024,
    passes: int = 2,
) -> DataFrame:
    """``value_at_rank`` by radix selection: raw values are counted where they are and never shuffled.

    A first pass finds each group's size and range. Every further pass cuts the range that holds a position into
    ``cells`` cells, counts the rows of each, and keeps the one cell that holds the position, with the smallest and
    largest value in it. Counts are folded per task, so an exchange carries at most ``cells`` rows per position and
    task. A last pass counts the distinct values of the cells left, which hold about a share of 1 / ``cells`` **
    ``passes`` of spread-out values, or few distinct ones. It is exact whatever they hold.

    Nulls are left out; NaN sorts last. Infinite values leave a range uncut, and the last pass settles it.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    fetched = fetch_if_small(sizes)
    # With few groups what a pass keeps is few rows as well: one per group and position.
    near = (lambda frame: frame) if fetched is sizes else F.broadcast
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.greatest(fn(F.col("n")).cast("bigint"), F.lit(0)).alias("within"))
        for name, fn in targets.items()
    ]))
    named = {k: f"_of_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(of)) for k, of in named.items()]
    of, place = list(named.values()), [*named.values(), "_target"]
    state = fetched.select(*[F.col(k).alias(o) for k, o in named.items()], "n", "_low", "_high", wanted.alias("_t")).select(
        *of, "n", "_low", "_high", F.col("_t.name").alias("_target"), F.col("_t.within").alias("_within")
    )
    inside = [*same, F.col("_v").between(F.col("_low"), F.col("_high"))]
    for _ in range(passes):
        span = F.col("_high").cast("double") - F.col("_low").cast("double")
        share = F.try_divide(F.col("_v").cast("double") - F.col("_low").cast("double"), span)
        flat = F.isnan(share) | share.isNull() | F.isnan(span) | (F.abs(span) == float("inf"))
        cell = F.when(flat, 0).otherwise(F.least(F.lit(cells - 1), F.floor(share * cells)))
        counted = rows.join(near(state), inside).groupBy(*place, cell.alias("_cell")).agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
            F.first("n").alias("n"), F.first("_within").alias("_within"),
        )
        upto = F.sum("_rows").over(Window.partitionBy(*place).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
        before = F.col("_upto") - F.col("_rows")
        state = (
            counted.withColumn("_upto", upto)
            .where((before <= F.col("_within")) & (F.col("_within") < F.col("_upto")))
            .select(*of, "n", F.col("_least").alias("_low"), F.col("_most").alias("_high"), "_target", (F.col("_within") - before).alias("_within"))
        )
    left = rows.join(near(state), inside).groupBy(*place, "_v").agg(
        F.count(F.lit(1)).alias("_rows"), F.first("n").alias("n"), F.first("_within").alias("_within")
    )
    upto = F.sum("_rows").over(Window.partitionBy(*place).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    reached = left.withColumn("_upto", upto).where(F.col("_upto") > F.col("_within"))
    return reached.groupBy(*[F.col(o).alias(k) for k, o in named.items()]).agg(
        F.max("n").alias("n"), *[F.min(F.when(F.col("_target") == name, F.col("_v"))).alias(name) for name in targets]
    )

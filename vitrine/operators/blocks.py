"""Blocked similarity joins: exact top-k and exact threshold search.

Scoring every query against every candidate that shares its keys is the work
itself, but the pairs never become rows. Each key group is cut into blocks of
bounded size on both sides (more blocks for a bigger group, so a hot key only
means more tasks), every pair of blocks is one co-group, and the co-group is a
matrix product that returns only the survivors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .skew import SMALL_TABLE_ROWS, fetch_if_small

SCORE_DIGITS = 12
ROUNDING = 10.0**-SCORE_DIGITS
# Every row is sent once per block of the other side, so blocks of like size move the fewest rows for the memory of a task.
QUERY_BLOCK = 8_192
CATALOGUE_BLOCK = 8_192
DUPLICATE_BLOCK = 16_384
_TILE_CELLS = 500_000


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) % len(column):
        raise ValueError("vectors of different dimensions share a key")
    return flat.reshape(len(column), -1)


def _unit_rows(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised rows and the positions of the rows whose norm is not zero."""
    m = np.asarray(m, dtype=np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    keep = np.flatnonzero(norms > 0)
    if len(keep) < len(m):
        m, norms = m[keep], norms[keep]
    return m / norms[:, None], keep


def _scores(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    if metric == "hamming":
        differing = np.bitwise_count(q[:, None, :] ^ c[None, :, :])
        return -differing.sum(axis=2, dtype=np.int64).astype(np.float64)
    return q @ c.T


def _sign_words(m: np.ndarray) -> np.ndarray:
    """One bit per component, packed into words of 64."""
    bits = np.packbits(m > 0, axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def _prepare(table: pa.Table, vector: str, metric: str, view: tuple[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    m = _matrix(table, vector)
    if view is not None:
        m = m[:, : view[1]]
        if view[0] == "signs":
            m = _sign_words(m)
    if metric == "cosine":
        return _unit_rows(m)
    if metric == "hamming":
        return m.astype(np.uint64), np.arange(len(m))  # bit counts of signed words would be those of their absolute value
    return np.asarray(m, dtype=np.float64), np.arange(len(m))


def _matches(a: pa.Table, b: pa.Table, a_at: np.ndarray, b_at: np.ndarray, finer: tuple[str, str] | None):
    """Row positions on both sides that may meet: all, or those that agree on the finer key.

    Positions stay ascending, so the id order of a side is kept.
    """
    if finer is None:
        yield np.arange(len(a_at)), np.arange(len(b_at))
        return
    aw, bw = a.column(finer[0]).to_numpy()[a_at], b.column(finer[1]).to_numpy()[b_at]
    ao, bo = np.argsort(aw, kind="stable"), np.argsort(bw, kind="stable")
    aw, bw = aw[ao], bw[bo]
    shared = np.intersect1d(aw, bw)
    cuts = [np.searchsorted(w, shared, side) for w in (aw, bw) for side in ("left", "right")]
    for a0, a1, b0, b1 in zip(*cuts):
        yield ao[a0:a1], bo[b0:b1]


def _agree(asked: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which rows and columns have a number in common in some table; ``asked`` is (row, table, number), ``own`` (column, table)."""
    met = np.zeros((len(asked), len(own)), dtype=bool)
    for table in range(asked.shape[1]):
        for nth in range(asked.shape[2]):
            met |= asked[:, table, nth, None] == own[None, :, table]
    return met


def _best_per_row(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the k best columns per row; the lower column wins a tie.

    Scores count to SCORE_DIGITS, so that equal vectors tie exactly wherever they
    sit in a block. Everything that could round up to the k-th best is a candidate.
    """
    width = scores.shape[1]
    if width > k:
        floor = np.partition(scores, width - k, axis=1)[:, width - k] - 2 * ROUNDING
        rows, cols = np.nonzero(scores >= floor[:, None])
    else:
        rows, cols = np.nonzero(np.ones(scores.shape, dtype=bool))
    vals = np.round(scores[rows, cols], SCORE_DIGITS)
    order = np.lexsort((cols, -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep], vals[keep]


def _cosines(q: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Cosine of the listed pairs, a bounded number at a time; 0 where a vector is zero."""
    q, c = np.asarray(q, dtype=np.float64), np.asarray(c, dtype=np.float64)
    norms = [np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (q, c)]
    out = np.zeros(len(rows))
    step = max(1, _TILE_CELLS // max(1, q.shape[1]))
    for start in range(0, len(rows), step):
        i, j = rows[start : start + step], cols[start : start + step]
        length = norms[0][i] * norms[1][j]
        out[start : start + step] = np.einsum("ij,ij->i", q[i], c[j]) / np.where(length > 0, length, 1)
    return out


def _blocks(rows: Column, per_block: int) -> Column:
    return F.ceil(rows / per_block).cast("int")


def _block_of(id_column: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column)), F.col(blocks)).cast("int")


def _every(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def block_topk(
    queries: DataFrame,
    catalogue: DataFrame,
    k: int,
    keys: list[str],
    metric: str = "cosine",
    query_id: str = "query_id",
    product_id: str = "product_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    catalogue_block: int = CATALOGUE_BLOCK,
    small_limit: int = SMALL_TABLE_ROWS,
    within: str | None = None,
    view: tuple[str, int] | None = None,
    carry: list[str] | None = None,
    shared: str | None = None,
) -> DataFrame:
    """(query, product, score): at most ``k`` survivors per query and catalogue block.

    ``metric`` is ``cosine``, ``dot`` or ``hamming`` (negated distance over packed
    words). Rows without a vector take no part. Ids must be unique on each side
    of a key. ``within`` is a finer integer key that must agree as well; its many
    small groups are matched inside a block instead of being one task call each. ``shared`` is an array of small integers,
    one per hash table on the catalogue's side and equally many per table on the queries'; only pairs that agree in some
    table are found, and a vector is sent once for all its tables.

    With ``view`` the survivors are chosen by a part of the vectors, (``prefix``, n) for their first n components or
    (``signs``, n) for those components' signs, and ``full_score`` is their cosine over the whole vectors: the block
    holds both, so nothing has to be joined to them later. ``carry`` names catalogue columns the survivors keep.
    ``merge_topk`` turns the result into the final ranking.
    """
    # Aliases give both sides columns of their own, even when they stem from one table.
    named = [F.col(k).alias(f"_key_{k}") for k in keys]
    finer = [F.col(within).alias("_w")] if within else []
    finer += [F.col(shared).alias("_s")] if shared else []
    q = queries.where(F.col(vector).isNotNull()).select(
        F.col(query_id).alias("_q"), *named, *finer, F.col(vector).alias("_v")
    )
    carry = carry or []
    kept_names = [f"_carry_{name}" for name in carry]
    c = catalogue.where(F.col(vector).isNotNull()).select(
        F.col(product_id).alias("_p"), *named, *finer, F.col(vector).alias("_v"),
        *[F.col(name).alias(kept) for name, kept in zip(carry, kept_names)],
    )
    keys = [f"_key_{k}" for k in keys]
    one, none = F.lit(1), F.lit(0)
    rows = q.select(*keys, one.alias("_q"), none.alias("_c")).unionByName(c.select(*keys, none.alias("_q"), one.alias("_c")))
    # Keys that one side lacks get no block, so their rows leave before the shuffle.
    sizes = fetch_if_small(
        rows.groupBy(*keys)
        .agg(_blocks(F.sum("_q"), query_block).alias("_nq"), _blocks(F.sum("_c"), catalogue_block).alias("_nc"))
        .where((F.col("_nq") > 0) & (F.col("_nc") > 0)),
        small_limit,
    )
    grid, carried = [*keys, "_qb", "_cb"], ["_w"] * bool(within) + ["_s"] * bool(shared)
    q = (
        q.join(sizes, keys)
        .withColumn("_qb", _block_of("_q", "_nq"))
        .withColumn("_cb", _every("_nc"))
        .select("_q", *grid, *carried, "_v")
    )
    c = (
        c.join(sizes, keys)
        .withColumn("_cb", _block_of("_p", "_nc"))
        .withColumn("_qb", _every("_nq"))
        .select("_p", *grid, *carried, "_v", *kept_names)
    )
    out = StructType().add("query_id", q.schema["_q"].dataType).add("product_id", c.schema["_p"].dataType).add("score", "double")
    id_types = [f.type for f in _arrow_schema(q.select("_q"), c.select("_p"))]
    names, types = ["query_id", "product_id", "score"], [*id_types, pa.float64()]
    if view is not None:
        out, names, types = out.add("full_score", "double"), [*names, "full_score"], [*types, pa.float64()]
    for name, kept in zip(carry, kept_names):
        out.add(name, c.schema[kept].dataType)
    names, types = [*names, *carry], [*types, *(f.type for f in _arrow_schema(c.select(*kept_names)))]

    def score_block(left: pa.Table, right: pa.Table) -> pa.Table:
        found_q, found_p, found_s = [], [], []
        if left.num_rows and right.num_rows:
            right = right.take(pc.sort_indices(right.column("_p")))
            qm, q_at = _prepare(left, "_v", metric, view)
            cm, c_at = _prepare(right, "_v", metric, view)
            if shared:
                own = _matrix(right, "_s")[c_at]
                asked = _matrix(left, "_s")[q_at].reshape(len(q_at), own.shape[1], -1)
            for q_rows, c_rows in _matches(left, right, q_at, c_at, ("_w", "_w") if within else None):
                cells = max(1, len(c_rows)) * (cm.shape[1] if metric == "hamming" else 1)
                tile = max(1, _TILE_CELLS // cells)
                for start in range(0, len(q_rows) if len(c_rows) else 0, tile):
                    some = q_rows[start : start + tile]
                    scores = _scores(qm[some], cm[c_rows], metric)
                    if shared:
                        scores = np.where(_agree(asked[some], own[c_rows]), scores, -np.inf)
                    rows, cols, vals = _best_per_row(scores, k)
                    if shared:
                        rows, cols, vals = (x[vals != -np.inf] for x in (rows, cols, vals))
                    found_q.append(q_at[some[rows]])
                    found_p.append(c_at[c_rows[cols]])
                    found_s.append(vals)
        rows = np.concatenate(found_q) if found_q else np.empty(0, dtype=np.int64)
        cols = np.concatenate(found_p) if found_p else np.empty(0, dtype=np.int64)
        vals = np.concatenate(found_s) if found_s else np.empty(0)
        if not len(rows):
            return pa.table([pa.array([], t) for t in types], names=names)
        made = [left.column("_q").take(pa.array(rows)), right.column("_p").take(pa.array(cols)), pa.array(vals)]
        if view is not None:
            made.append(pa.array(_cosines(_matrix(left, "_v"), _matrix(right, "_v"), rows, cols)))
        return pa.table([*made, *(right.column(kept).take(pa.array(cols)) for kept in kept_names)], names=names)

    return q.groupBy(*grid).cogroup(c.groupBy(*grid)).applyInArrow(score_block, out)


def _arrow_schema(*frames: DataFrame) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [field for df in frames for field in to_arrow_schema(df.schema)]


def merge_topk(partial: DataFrame, k: int, carry: list[str] | None = None) -> DataFrame:
    """Final ranking per query: score descending, product id ascending, ranks from 1.

    The rank filter is pushed below the shuffle as a per-task limit.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("product_id"))
    return (
        partial.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "product_id", "score", *(carry or []))
    )


def _with_lower_partner(a: np.ndarray, b: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray, threshold: float) -> list[np.ndarray]:
    """Ids of either side (both in id order) with a lower id of the other within the threshold.

    The first hit in id order decides: a lower partner exists iff that one is lower.
    """
    dropped = []
    lowest_a = np.full(len(b_ids), -1)
    tile = max(1, _TILE_CELLS // max(1, len(b_ids)))
    for start in range(0, len(a_ids) if len(b_ids) else 0, tile):
        hit = a[start : start + tile] @ b.T >= threshold - ROUNDING / 2
        rows = np.flatnonzero(hit.any(axis=1))
        lower = b_ids[hit[rows].argmax(axis=1)] < a_ids[start + rows]
        dropped.append(a_ids[start + rows[lower]])
        fresh = np.flatnonzero(hit.any(axis=0) & (lowest_a < 0))
        lowest_a[fresh] = start + hit[:, fresh].argmax(axis=0)
    seen = np.flatnonzero(lowest_a >= 0)
    lower = a_ids[lowest_a[seen]] < b_ids[seen]
    dropped.append(b_ids[seen[lower]])
    return dropped


def _near_cells(a: np.ndarray, b: np.ndarray, threshold: float):
    """Row positions on both sides that may be within the threshold, by pivot angles; unit rows, exact.

    Every row of ``b`` belongs to the cell of its nearest pivot. Angles obey the triangle inequality, so a row of ``a``
    can have a partner in a cell only if its angle to the pivot is at most the cell's largest one and the threshold's
    together. Vectors in clusters leave few such cells; where most would be met, one product of all is cheaper.
    """
    n = int(np.sqrt(len(b)))
    if n < 8 or not len(a) or threshold <= 0:
        yield np.arange(len(a)), np.arange(len(b))
        return
    pivots = b[np.linspace(0, len(b) - 1, n).astype(np.int64)]
    own, far = np.empty(len(b), dtype=np.int64), np.zeros(n)
    tile = max(8, _TILE_CELLS // n // 8 * 8)  # whole bytes of packed rows
    for start in range(0, len(b), tile):
        angles = np.arccos(np.clip(b[start : start + tile] @ pivots.T, -1, 1))
        nearest = angles.argmin(axis=1)
        own[start : start + tile] = nearest
        np.maximum.at(far, nearest, angles[np.arange(len(angles)), nearest])
    reach = np.cos(np.minimum(far + np.arccos(min(threshold, 1.0)) + 1e-6, np.pi))  # slack for rounding
    met = np.concatenate([np.packbits(a[start : start + tile] @ pivots.T >= reach, axis=0) for start in range(0, len(a), tile)])
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(n + 1))
    sizes = np.diff(cuts)
    pairs = (np.bitwise_count(met).sum(axis=0, dtype=np.int64) * sizes).sum()
    if pairs > 0.5 * len(a) * len(b):
        yield np.arange(len(a)), np.arange(len(b))
        return
    for j in np.flatnonzero(sizes):
        rows = np.flatnonzero(np.unpackbits(met[:, j])[: len(a)])
        if len(rows):
            yield rows, order[cuts[j] : cuts[j + 1]]


def block_duplicates(
    vectors: DataFrame,
    threshold: float,
    keys: list[str],
    id_column: str = "product_id",
    vector: str = "embedding",
    block: int = DUPLICATE_BLOCK,
    small_limit: int = SMALL_TABLE_ROWS,
    within: str | None = None,
) -> DataFrame:
    """Ids that have a lower id within cosine ``threshold`` under the same keys.

    Only pairs of blocks i <= j are formed. A block pair answers, for each of its
    ids, whether some lower id is close enough; matching pairs are never listed,
    so a large set of copies costs no more than any other rows. Inside a pair of blocks
    only rows meet that pivot angles cannot keep apart. ``within`` works as in ``block_topk``.
    """
    finer = [F.col(within).alias("_w")] if within else []
    v = vectors.where(F.col(vector).isNotNull()).select(F.col(id_column).alias("_p"), *keys, *finer, F.col(vector).alias("_v"))
    # A row alone under its keys has no partner and leaves before the shuffle.
    rows = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    sizes = rows.select(*keys, _blocks(F.col("_rows"), block).alias("_n"))
    blocked = v.join(fetch_if_small(sizes, small_limit), keys).withColumn("_b", _block_of("_p", "_n"))
    carry = lambda name: [F.col("_w").alias(name)] if within else []
    later = F.explode(F.sequence(F.col("_b"), F.col("_n") - 1))
    earlier = F.explode(F.sequence(F.lit(0), F.col("_b")))
    # Both sides descend from one table, so each gets column names of its own.
    left = blocked.select(F.col("_p").alias("_lp"), *[F.col(k).alias(f"_l{k}") for k in keys],
                          F.col("_b").alias("_li"), later.alias("_lj"), *carry("_lw"), F.col("_v").alias("_lv"))
    right = blocked.select(F.col("_p").alias("_rp"), *[F.col(k).alias(f"_r{k}") for k in keys],
                           earlier.alias("_ri"), F.col("_b").alias("_rj"), *carry("_rw"), F.col("_v").alias("_rv"))
    grid = [*keys, "i", "j"]
    out = StructType().add("drop_id", v.schema["_p"].dataType)
    id_type = _arrow_schema(v.select("_p"))[0].type

    def find(a: pa.Table, b: pa.Table) -> pa.Table:
        dropped = []
        if a.num_rows and b.num_rows:
            a = a.take(pc.sort_indices(a.column("_lp")))
            b = b.take(pc.sort_indices(b.column("_rp")))
            am, a_at = _prepare(a, "_lv", "cosine")
            bm, b_at = _prepare(b, "_rv", "cosine")
            a_ids = a.column("_lp").to_numpy()[a_at]
            b_ids = b.column("_rp").to_numpy()[b_at]
            for a_rows, b_rows in _matches(a, b, a_at, b_at, ("_lw", "_rw") if within else None):
                for a_near, b_near in _near_cells(am[a_rows], bm[b_rows], threshold):
                    some, other = a_rows[a_near], b_rows[b_near]
                    dropped += _with_lower_partner(am[some], bm[other], a_ids[some], b_ids[other], threshold)
        ids = np.unique(np.concatenate(dropped)) if dropped else []
        return pa.table([pa.array(ids, id_type)], names=["drop_id"])

    pairs = left.groupBy(*[f"_l{g}" for g in grid]).cogroup(right.groupBy(*[f"_r{g}" for g in grid]))
    return pairs.applyInArrow(find, out).distinct()

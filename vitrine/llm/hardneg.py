"""Hard negatives by anchor spanning-tree bounds.

Anchors are cut into blocks; each block has a minimum spanning tree over its vectors. A candidate's score at the root
of a tree is computed. At a child anchor it lies within the score at the parent plus or minus (length of the edge) x
(norm of the candidate), so only candidates whose interval meets a window that matters are scored again; the others
hand their interval on. Blocks of anchors meet blocks of candidates, one task each, and a task returns the best few of
every window, so pairs never become rows and a hot label only means more blocks.

Two passes: the first finds each anchor's positives (best rows of its label; what matters is the floor set by the
rows known so far), the second the negatives inside the window that each positive's score opens.

Scores are exact integers: products of floor(256 * component). Defined cases: rows with a null label, a null vector, a
null or non-finite component take no part, nor do those whose scores a long could not hold (a component of 2**23 or
more, a squared integer norm of 2**62 or more). Vectors meet vectors of their own length; an empty vector scores 0.
Copies of a row are rows of their own, but an anchor id names one anchor, the row with the least label and vector, and
no row with its id is a positive of it. A null id is no anchor and comes last among ties. Empty tables give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import numbered, stored

SCALE = 256
LARGEST = float(2**23)
ANCHOR_BLOCK = 1_024
CANDIDATE_BLOCK = 16_384
TILE = 2_048
EXACT = 2.0**53
NO_ID = 2**63 - 1


def integer_rows(df: DataFrame, id_col: str, vector: str, label: Column) -> DataFrame:
    """(id, label, dim, v): rows that take part, with floor(256 * x) components."""
    wild = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = df.where(F.col(vector).isNotNull() & ~F.coalesce(wild, F.lit(False))).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), label.cast("long").alias("label"), v.alias("v")
    )
    return rows.where(F.col("label").isNotNull() & (square < 2.0**62)).select("id", "label", F.size("v").alias("dim"), "v")


def _matrix(table: pa.Table, name: str = "v") -> np.ndarray:
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(table.num_rows, len(flat) // max(1, table.num_rows))


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree: rows in an order in which parents come first."""
    n = len(m)
    order, parent, edge = np.zeros(n, dtype=np.int64), np.full(n, -1), np.zeros(n)
    x = m.astype(np.float64)
    # The root lies nearest to the mean, which keeps the tree flat.
    at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
    nearest, source = np.full(n, np.inf), np.full(n, -1)
    open_ = np.ones(n, dtype=bool)
    for k in range(n):
        order[k], parent[at], edge[at] = at, source[at], 0.0 if source[at] < 0 else nearest[at]
        open_[at] = False
        far = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = open_ & (far < nearest)
        nearest[closer], source[closer] = far[closer], at
        at = int(np.where(open_, nearest, np.inf).argmin())
    return order, parent, edge


def _plant(block: pa.Table) -> pa.Table:
    """A block of anchors in tree order, with the place of the parent in the block and the length of the edge."""
    m = _matrix(block)
    order, parent, edge = spanning_tree(m)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    up = np.where(parent[order] < 0, -1, place[parent[order]])
    planted = block.take(pa.array(order))
    return planted.append_column("place", pa.array(np.arange(len(order)))).append_column("up", pa.array(up)).append_column("edge", pa.array(edge[order]))


def anchor_trees(anchors: DataFrame, block: int = ANCHOR_BLOCK) -> DataFrame:
    """(id, label, dim, v, block, place, up, edge): anchors in blocks by (dim, label, leading signs), one tree each."""
    one = anchors.groupBy("id").agg(F.min(F.struct("label", "dim", "v")).alias("a")).select("id", "a.*")
    signs = F.array_join(F.transform(F.slice("v", 1, 16), lambda x: F.when(x < 0, "0").otherwise("1")), "")
    rows = numbered(one.withColumn("signs", signs), ["dim", "label", "signs", "id"], "anchors")
    blocked = rows.select("id", "label", "dim", "v", F.floor(F.col("_number") / block).alias("block"))
    planted = blocked.groupBy("dim", "block").applyInArrow(
        _plant, "id long, label long, dim int, v array<int>, block long, place long, up long, edge double"
    )
    return stored(planted, "anchor-trees")


class Walk:
    """One block of anchors over tiles of candidates: intervals down the tree, scores where they matter."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        a, c = _matrix(anchors), _matrix(rows)
        norms = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)) for m in (a, c)]
        # Every partial sum stays below the product of the norms, so doubles are exact where that is below 2**53.
        small = norms[0].max() * norms[1].max() < EXACT
        self.anchors, self.rows = (a.astype(np.float64), c.astype(np.float64)) if small else (a, c)
        self.norms = norms[1]
        place = anchors.column("place").to_numpy()
        self.sequence = np.argsort(place, kind="stable")
        at = {p: i for i, p in enumerate(place.tolist())}
        # A parent outside of this group of the block makes a row a root.
        self.up = [at.get(p, -1) for p in anchors.column("up").to_pylist()]
        self.edge = anchors.column("edge").to_numpy()
        self.scored = 0

    def run(self, wanted, found) -> None:
        """``wanted(anchor, low, high, rows)`` marks the rows to score, ``found(anchor, rows, scores)`` takes them."""
        for start in range(0, len(self.rows), TILE):
            tile = slice(start, min(start + TILE, len(self.rows)))
            rows, norms = self.rows[tile], self.norms[tile]
            low, high = (np.empty((len(self.anchors), len(rows))) for _ in range(2))
            for i in self.sequence:
                up = self.up[i]
                if up < 0:
                    score = rows @ self.anchors[i]
                    low[i], high[i] = score, score
                    picked = np.flatnonzero(wanted(i, low[i], high[i], tile))
                    score = score[picked]
                    self.scored += len(rows)
                else:
                    # Wider by what rounding could take away.
                    slack = self.edge[i] * norms * (1 + 1e-9) + 1 + 2.0**-50 * np.maximum(np.abs(low[up]), np.abs(high[up]))
                    low[i], high[i] = low[up] - slack, high[up] + slack
                    picked = np.flatnonzero(wanted(i, low[i], high[i], tile))
                    score = rows[picked] @ self.anchors[i]
                    low[i, picked] = high[i, picked] = score
                    self.scored += len(picked)
                if len(picked):
                    found(i, picked + start, score.astype(np.int64))


def _first(k: int, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Positions of the k best: higher scores, then smaller ids."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def find_positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best other rows for each anchor of a block, all of one label: (anchor_id, id, score)."""
    out: list[tuple[np.ndarray, ...]] = []
    if anchors.num_rows and rows.num_rows:
        walk = Walk(anchors, rows)
        own, ids = anchors.column("id").to_numpy(), rows.column("id").to_numpy()
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def wanted(i, low, high, tile):
            other = ids[tile] != own[i]
            floor = best[i][1].min() if i in best and len(best[i][1]) == k else -np.inf
            lows = low[other]
            if len(lows) >= k:  # so many rows reach at least this
                floor = max(floor, np.partition(lows, len(lows) - k)[len(lows) - k])
            return other & (high >= floor)

        def found(i, picked, scores):
            some, held = ids[picked], scores
            if i in best:
                some, held = np.concatenate([best[i][0], some]), np.concatenate([best[i][1], held])
            keep = _first(k, some, held)
            best[i] = (some[keep], held[keep])

        walk.run(wanted, found)
        out = [(np.full(len(some), own[i]), some, held) for i, (some, held) in best.items()]
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3
    return pa.table([pa.array(c) for c in columns], names=["anchor_id", "id", "score"])


def windows(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score, as integers from and to."""
    return -((-low * score) // 100), (high * score) // 100


def find_negatives(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The k best rows of other labels in each window: (anchor_id, positive_rank, id, score)."""
    out: list[tuple[np.ndarray, ...]] = []
    if anchors.num_rows and rows.num_rows:
        walk = Walk(anchors, rows)
        own, labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        ids, theirs = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        opened = [
            [(rank, *windows(score, low, high)) for rank, score in enumerate(scores, 1)]
            for scores in anchors.column("positive_scores").to_pylist()
        ]
        opened = [[w for w in ws if w[1] <= w[2]] for ws in opened]
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def wanted(i, lows, highs, tile):
            meets = np.zeros(len(lows), dtype=bool)
            for _, least, most in opened[i]:
                meets |= (highs >= least) & (lows <= most)
            return meets & (theirs[tile] != labels[i])

        def found(i, picked, scores):
            for rank, least, most in opened[i]:
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                some, held = ids[picked[inside]], scores[inside]
                if (i, rank) in best:
                    some, held = np.concatenate([best[i, rank][0], some]), np.concatenate([best[i, rank][1], held])
                keep = _first(k, some, held)
                best[i, rank] = (some[keep], held[keep])

        walk.run(wanted, found)
        out = [(np.full(len(some), own[i]), np.full(len(some), rank), some, held) for (i, rank), (some, held) in best.items()]
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 4
    return pa.table([pa.array(c) for c in columns], names=["anchor_id", "positive_rank", "id", "score"])


def _pieces(rows: DataFrame, keys: list[str], anchors: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """Candidates once per anchor block of their key, anchors once per piece of the candidates of their key."""
    pieces = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("_pieces"))
    blocks = anchors.groupBy(*keys).agg(F.collect_set("block").alias("_blocks"))
    sizes = stored(pieces.join(blocks, keys), "anchor-pieces")
    spread = F.pmod(F.xxhash64("id", "v"), F.col("_pieces")).cast("int").alias("piece")
    dealt = rows.join(sizes, keys).select(*rows.columns, spread, F.explode("_blocks").alias("block"))
    asked = anchors.join(sizes.select(*keys, "_pieces"), keys).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    return asked.drop("_pieces"), dealt


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    anchor_block: int = ANCHOR_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    ``rows`` and ``anchors`` are as ``integer_rows`` gives them; anchors may be rows too. For each anchor and each of
    its best ``positives`` rows of the same label: the best ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` per cent of the positive's.
    """
    rows = stored(rows, "anchor-rows")
    trees = anchor_trees(anchors, anchor_block)
    best = lambda *keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    asked, dealt = _pieces(rows, ["dim", "label"], trees, candidate_block)
    grid = ["dim", "label", "block", "piece"]
    found = asked.groupBy(*grid).cogroup(dealt.groupBy(*grid)).applyInArrow(
        lambda a, c: find_positives(a, c, positives), "anchor_id long, id long, score long"
    )
    ranked = found.withColumn("positive_rank", F.row_number().over(best("anchor_id"))).where(F.col("positive_rank") <= positives)
    chosen = stored(ranked, "anchor-positives")
    scores = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "score"))).alias("s"))
    with_scores = trees.join(scores.select(F.col("anchor_id").alias("id"), F.col("s.score").alias("positive_scores")), "id")
    asked, dealt = _pieces(rows, ["dim"], with_scores, candidate_block)
    grid = ["dim", "block", "piece"]
    near = asked.groupBy(*grid).cogroup(dealt.groupBy(*grid)).applyInArrow(
        lambda a, c: find_negatives(a, c, negatives, low, high), "anchor_id long, positive_rank long, id long, score long"
    )
    per = best("anchor_id", "positive_rank")
    kept = near.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= negatives)
    shown = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    named = chosen.select("anchor_id", F.col("positive_rank").cast("long").alias("positive_rank"), F.col("id").alias("_p"), F.col("score").alias("positive_score"))
    return kept.join(named, ["anchor_id", "positive_rank"]).select(
        "anchor_id", shown("_p").alias("positive_id"), "rank", shown("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), "positive_rank",
    )


#: What ``op13_hard_negatives`` returns, by scoring everything.
SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM part a JOIN part c ON len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scored WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""

"""Contrastive loss values of a table of (anchor, positive) vectors.

Rows are dealt to batches by a hash of their id, about ``batch_size`` each. The
pairwise logits of a batch exist only as a matrix inside its task; one row per
batch comes out. ``loss_report`` averages the batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import hash_bucket
from .blocks import _matrix

TEMPERATURE = 0.07
SIGLIP_BIAS = -10.0

Loss = Callable[[np.ndarray, np.ndarray, "np.ndarray | None"], float]


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=-1, keepdims=True))
    return m / np.maximum(norms, 1e-12)


def _log_sum_exp(m: np.ndarray) -> np.ndarray:
    top = m.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(m - top).sum(axis=1, keepdims=True)))[:, 0]


def info_nce(temperature: float = TEMPERATURE) -> Loss:
    """Symmetric in-batch cross-entropy: each anchor against all positives and back."""

    def loss(a, p, _=None):
        logits = _unit(a) @ _unit(p).T / temperature
        own = np.diagonal(logits)
        return float(((_log_sum_exp(logits) - own).mean() + (_log_sum_exp(logits.T) - own).mean()) / 2)

    return loss


def sig_lip(temperature: float = TEMPERATURE, bias: float = SIGLIP_BIAS) -> Loss:
    """Independent sigmoid per pair: matching pairs +1, all others -1."""

    def loss(a, p, _=None):
        z = _unit(a) @ _unit(p).T / temperature + bias
        np.fill_diagonal(z, -np.diagonal(z))
        return float(np.logaddexp(0.0, z).sum() / len(z))

    return loss


def hard_negative_nce(temperature: float = TEMPERATURE) -> Loss:
    """Anchor-to-positive cross-entropy with extra mined negatives per anchor."""

    def loss(a, p, negatives=None):
        anchors, own = _unit(a), _unit(p)
        # A missing negative (a row of NaN) takes no part in the sum.
        missing = np.isnan(negatives).any(axis=2)
        mined = np.matmul(_unit(np.nan_to_num(negatives)), anchors[:, :, None])[:, :, 0]
        rivals = np.where(missing, -np.inf, mined / temperature)
        in_batch = anchors @ own.T / temperature
        target = (anchors * own).sum(axis=1) / temperature
        return float(np.mean(_log_sum_exp(np.concatenate([in_batch, rivals], axis=1)) - target))

    return loss


def matryoshka(base: Loss, dims: tuple[int, ...]) -> Loss:
    """Weighted sum of a loss over leading dimensions, weights proportional to 1/sqrt(dim)."""
    weights = {d: d**-0.5 for d in sorted(dims)}
    total = sum(weights.values())

    def loss(a, p, negatives=None):
        return sum(
            w / total * base(a[:, :d], p[:, :d], None if negatives is None else negatives[:, :, :d])
            for d, w in weights.items()
        )

    return loss


def _padded(rows: list[list | None], dim: int) -> np.ndarray:
    """Vectors per row as one array; rows with fewer end in NaN."""
    out = np.full((len(rows), max((len(r or []) for r in rows), default=0), dim), np.nan)
    for n, vectors in enumerate(rows):
        if vectors:
            out[n, : len(vectors)] = vectors
    return out


def batch_losses(pairs: DataFrame, loss: Loss, n_batches: int, negatives: str | None = None) -> DataFrame:
    """(batch, n_pairs, loss) over ``pair_id, anchor, positive`` and optional negatives.

    ``negatives`` names an ``array<array>`` column; rows may have different numbers of vectors, or none.
    """
    columns = ["anchor", "positive"] + ([negatives] if negatives else [])
    batched = pairs.select(
        hash_bucket("pair_id", n_batches, "md5").cast("int").alias("batch"), *columns
    )

    def evaluate(key, table):
        a, p = (_matrix(table, c).astype(np.float64) for c in ("anchor", "positive"))
        extra = None
        if negatives:
            extra = _padded(table.column(negatives).to_pylist(), a.shape[1])
        return pa.table({
            "batch": pa.array([key[0].as_py()], pa.int32()),
            "n_pairs": pa.array([len(a)], pa.int64()),
            "loss": pa.array([loss(a, p, extra)], pa.float64()),
        })

    return batched.groupBy("batch").applyInArrow(evaluate, "batch int, n_pairs bigint, loss double")


def loss_report(per_batch: DataFrame) -> DataFrame:
    """Mean loss over batches."""
    return per_batch.agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("n_pairs").alias("n_pairs"), F.avg("loss").alias("loss")
    )

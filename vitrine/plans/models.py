"""Deterministic stand-ins for the neural models; they follow the same contract."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

DIM = 64


def _slot(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DIM


def _bag_of_words(text: str, slot: Callable[[str], int]) -> np.ndarray:
    v = np.zeros(DIM)
    for word, n in Counter(text.split(" ")).items():
        v[slot(word)] += n
    return v / np.sqrt((v * v).sum())


def text_encoder(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``doc_id, text`` to a unit vector of hashed word counts; empty texts are left out."""
    slot = lru_cache(maxsize=20_000)(_slot)
    for batch in batches:
        readable = batch[batch["text"].notna() & (batch["text"] != "")]
        # An object column, so that a batch without readable texts still has the right type.
        vectors = pd.Series([_bag_of_words(t, slot) for t in readable["text"]], index=readable.index, dtype=object)
        yield pd.DataFrame({"doc_id": readable["doc_id"], "embedding": vectors})


LABELS = np.array(["bag", "bottom", "dress", "hat", "outer", "shoes", "top"], dtype=object)
SIDE = 200


def box_detector(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``post_id, o_custkey`` to zero to three boxes on a 200 x 200 image; none where a number is missing."""
    for batch in batches:
        batch = batch[batch["post_id"].notna() & batch["o_custkey"].notna()].astype("int64")
        # Remainders have the sign of the number, as in SQL.
        n = np.maximum(np.fmod(batch["post_id"].to_numpy(), 4), 0)
        rows = np.repeat(np.arange(len(batch)), n)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        post, cust = batch["post_id"].to_numpy()[rows], batch["o_custkey"].to_numpy()[rows]
        x1, y1 = np.fmod(cust * 7 + nth * 13, 100), (post * 3 + nth * 5) % 100
        w, h = 10 + post % 90, 10 + np.fmod(cust, 80)
        label = (post + nth) % len(LABELS)
        yield pd.DataFrame({
            "post_id": post, "label": label.astype("int32"), "category": LABELS[label],
            "score": ((post + nth * 17) % 100) / 100.0,
            "x1": x1 * 1.0, "y1": y1 * 1.0, "x2": (x1 + w) * 1.0, "y2": (y1 + h) * 1.0,
            "area_frac": w * h / float(SIDE * SIDE),
        })

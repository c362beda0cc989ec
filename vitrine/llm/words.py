"""Words of a text: runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

_KEEP = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)}
#: Byte by byte: capitals to small letters, everything that separates words to a blank.
FOLD = bytes(b if b in _KEEP else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: The same words in an original text, before lower-casing.
ORIGINAL = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, n.bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_BASE, _BACK):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps))
        _POWERS[size] = out[0], out[1]
    up, down = _POWERS[size]
    return up[:n], down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of many spans of one array of codes, each from two prefix sums."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, and where each text's words begin (one entry more than texts)."""
    folded = b" ".join([b"", *batch, b""]).translate(FOLD)
    codes = np.frombuffer(folded, np.uint8)
    inside = codes != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(batch) + 1, np.int64)
    at = np.cumsum([1, *(len(t) + 1 for t in batch)])
    return span_hashes(codes, starts, ends), np.searchsorted(starts, at)


#: 0 white space, 1 part of a word, 2 any other sign.
_CLASS = np.array([0 if b in b" \t\n\x0b\x0c\r" else 1 if FOLD[b] != 32 else 2 for b in range(256)], np.uint8)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def hashed_tokens(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``hashed_words``, of words and of runs of other signs."""
    whole = b" ".join([b"", *batch, b""])
    kinds = _CLASS[np.frombuffer(whole, np.uint8)]
    edges = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts, ends = edges[:-1], edges[1:]
    real = kinds[starts] > 0
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(batch) + 1, np.int64)
    at = np.cumsum([1, *(len(t) + 1 for t in batch)])
    return span_hashes(np.frombuffer(whole.translate(_LOWER), np.uint8), starts, ends), np.searchsorted(starts, at)

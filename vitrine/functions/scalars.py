"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Category names, band limits and thresholds that results must agree on.
CATEGORIES = ["bag", "bottom", "dress", "hat", "outer", "shoes", "top"]
SMALL_AREA = 0.08
MEDIUM_AREA = 0.30
HEAVY_OCCLUSION_AREA = 0.05


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key, buckets: int = 1000, mode: str = "murmur") -> Column:
    """Deterministic bucket of a key in ``[0, buckets)``.

    ``murmur`` uses Spark's own hash; ``md5`` can be recomputed by other engines.
    The key is cast to string first since Spark's hash depends on the type.
    """
    text = _col(key).cast("string")
    if mode == "murmur":
        return F.abs(F.hash(text) % buckets)
    if mode == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets
    raise ValueError(f"unknown hash mode {mode!r}")


def size_band(area) -> Column:
    a = _col(area)
    return F.when(a < SMALL_AREA, "small").when(a < MEDIUM_AREA, "medium").otherwise("large")


def occlusion(area) -> Column:
    return F.when(_col(area) < HEAVY_OCCLUSION_AREA, "heavy").otherwise("none")


def box_area_fraction(x1, y1, x2, y2, width, height) -> Column:
    return (
        (_col(x2) - _col(x1)) * (_col(y2) - _col(y1)) / (_col(width) * _col(height)).cast("double")
    )


def detection_id(image_id, label, x1, y1) -> Column:
    """24 hex characters of a SHA-256 over the image, the label and the box corner."""
    corner = [F.format_string("%.1f", _col(c)) for c in (x1, y1)]
    text = F.concat_ws("|", _col(image_id).cast("string"), _col(label).cast("string"), *corner)
    return F.substring(F.sha2(text, 256), 1, 24)


def whole_hours(start, end) -> Column:
    """Completed hours from ``start`` to ``end``."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def histogram_bin(value, bins: int = 20, lo: float = 0.0, hi: float = 1.0) -> Column:
    """0-based bin of equal width; NULL outside ``[lo, hi]``; the last bin is closed.

    The edges are ``lo + i * step`` computed in doubles, so the floored guess is
    corrected against them.
    """
    step = (hi - lo) / bins
    v = _col(value)
    guess = F.floor((v - lo) / step).cast("int")
    fixed = (
        F.when(v < F.lit(lo) + guess * F.lit(step), guess - 1)
        .when(v >= F.lit(lo) + (guess + 1) * F.lit(step), guess + 1)
        .otherwise(guess)
    )
    inside = (v >= lo) & (v <= hi)
    return F.when(inside, F.when(v >= hi, F.lit(bins - 1)).otherwise(F.least(fixed, F.lit(bins - 1))))


def psi_verdict(psi) -> Column:
    p = _col(psi)
    return F.when(p < 0.10, "stable").when(p < 0.25, "moderate shift").otherwise("significant shift")


def js_verdict(js) -> Column:
    j = _col(js)
    return F.when(j < 0.10, "stable").when(j < 0.20, "moderate shift").otherwise("significant shift")


def delta_verdict(delta, warn: float) -> Column:
    return F.when(F.abs(_col(delta)) < warn, "stable").otherwise("significant shift")

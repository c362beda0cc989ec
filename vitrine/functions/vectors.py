"""Column expressions over ``array<float|double>`` embeddings.

All arithmetic is done in double. Every expression stays JVM-side; a scalar that
is needed once per element (the norm) enters as a second array, because a lambda
would evaluate it again for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def as_double(v) -> Column:
    return _col(v).cast("array<double>")


def dot(a, b) -> Column:
    """Inner product of two equally long vectors."""
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def scale(v, factor: Column) -> Column:
    v = as_double(v)
    return F.zip_with(v, F.array_repeat(factor, F.size(v)), lambda x, s: x * s)


def unit(v) -> Column:
    """L2-normalised vector; NULL when the norm is zero."""
    v, n = as_double(v), norm(v)
    return F.when(
        n > 0, F.zip_with(v, F.array_repeat(n, F.size(v)), lambda x, s: x / s)
    )


def truncate(v, dim: int) -> Column:
    """First ``dim`` components (nested-representation embeddings), not renormalised."""
    return F.slice(_col(v), 1, dim)


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when either side has zero norm."""
    na, nb = norm(a), norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def int8(v) -> Column:
    """Unit vector quantised to integers in [-127, 127]."""
    return F.transform(unit(v), lambda x: F.round(x * 127).cast("int"))


def sign_bits(v, dim: int) -> Column:
    """One bit per component, 32 components to a word: ``array<bigint>``."""
    v = _col(v)
    words = []
    for start in range(0, dim, 32):
        words.append(
            F.aggregate(
                F.slice(v, start + 1, min(32, dim - start)),
                F.lit(0).cast("bigint"),
                lambda acc, x: acc * 2 + F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
            )
        )
    return F.array(*words)


def mean_vector(df: DataFrame, vector: str = "embedding", by: list[str] | None = None) -> DataFrame:
    """Element-wise mean of all vectors (per group when ``by`` is given), plus the row count.

    The mean is a partially aggregated summary, so a group's rows are folded
    before the shuffle and rows are not multiplied by the dimension.
    """
    rows = df.where(F.col(vector).isNotNull()).withColumn(
        "_vec", array_to_vector(as_double(vector))
    )
    # A constant key instead of none, so that no rows give no mean rather than an error.
    mean = rows.groupBy(*(by or [F.lit(1).alias("_all")])).agg(
        Summarizer.mean(F.col("_vec")).alias("_mean"), F.count(F.lit(1)).alias("n_vectors")
    )
    return mean.select(*(by or []), vector_to_array("_mean").alias("centroid"), "n_vectors")

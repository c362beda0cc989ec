"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import running_sum, slices, stored, with_fields
from .words import hashed_tokens, mixed, raw_texts

#: Buckets of the hashed n-gram models; they bound the models, whatever the corpus.
BUCKETS = 1 << 14
#: Most labelled rows that the target model is fitted on, chosen by a hash of the id.
TARGET_ROWS = 20_000
SMOOTHING = 1.0
SEED = 11


def grams(batch: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all single tokens and pairs of some texts, and where each text's buckets begin.

    Tokens are runs of letters and digits and runs of other signs, A-Z lower-cased. A pair of equal
    tokens counts as repetition, whatever the token.
    """
    tokens, at = hashed_tokens(batch)
    counts = np.diff(at)
    text = np.repeat(np.arange(len(counts)), counts)
    pairs = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    left, right = tokens[pairs], tokens[pairs + 1]
    both = np.where(left == right, np.uint64(1), mixed(left * np.uint64(3) + right))
    values = np.concatenate([tokens, both])
    owner = np.concatenate([text, text[pairs]])
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(counts) + 1))
    return (values[order] % np.uint64(buckets)).astype(np.int64), first


def _counts(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(bucket, raw, target): n-grams of all rows and of the target rows, in one pass; a task adds up before it sends."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marked = rows.join(F.broadcast(target.select(F.col("_target_id"), F.lit(True).alias("_is_target"))), F.col("_id") == F.col("_target_id"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, chosen = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in slices(batches, "_text"):
            found, first = grams(raw_texts(batch, "_text"), buckets)
            raw += np.bincount(found, minlength=buckets)
            mine = np.repeat([bool(x) for x in batch.column("_is_target").to_pylist()], np.diff(first))
            chosen += np.bincount(found[mine], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(raw[some]), pa.array(chosen[some])], ["bucket", "raw", "target"])

    partial = marked.select("_text", "_is_target").mapInArrow(run, "bucket long, raw long, target long")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, buckets: int, target_rows: int) -> tuple[np.ndarray, float]:
    """Log ratio of the target model to the raw model per bucket, and the share of good rows among all labelled ones.

    The raw model counts all rows, the target model the good rows among at most ``target_rows`` labelled ones. What comes
    to the driver is one row per bucket.
    """
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_target_id")).where("_target_id IS NOT NULL").distinct()
    target = stored(good.orderBy(F.xxhash64("_target_id"), "_target_id").limit(target_rows), "quality-target")
    share = labels.where(F.col(label_col).isNotNull()).agg(F.avg((F.col(label_col) == 1).cast("double"))).first()[0]
    raw, chosen = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in _counts(docs, target, id_col, text_col, buckets).collect():
        raw[bucket], chosen[bucket] = r, t
    if not chosen.sum():
        return np.zeros(buckets), 1.0
    p = (chosen + SMOOTHING) / (chosen.sum() + SMOOTHING * buckets)
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * buckets)
    return np.log(p / q), 1.0 if share is None else float(share)


def scored(docs: DataFrame, ratio: np.ndarray, id_col: str, text_col: str, seed: int = SEED) -> DataFrame:
    """Id, ``log_weight`` and ``gumbel_key`` (the weight plus Gumbel noise from a hash of seed, id and text) of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(F.lit(seed), id_col, text_col).alias("_noise"))
    model = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            weight, key = weights(raw_texts(batch, "_text"), model.value, np.array(batch.column("_noise").to_pylist(), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(weight), pa.array(key)], ["_id", "log_weight", "gumbel_key"])

    return rows.mapInArrow(run, with_fields(rows.schema["_id"], "log_weight double, gumbel_key double")).withColumnRenamed("_id", id_col)


def weights(batch: list[bytes], ratio: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, first = grams(batch, len(ratio))
    # Sums text by text, so that a text's weight does not depend on its neighbours.
    values = ratio[found]
    weight = np.array([values[a:b].sum() for a, b in zip(first[:-1], first[1:], strict=True)])
    uniform = (mixed(noise.view(np.uint64)) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54
    return weight, weight - np.log(-np.log(uniform))


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    share: float | None = None, buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, seed: int = SEED,
) -> DataFrame:
    """One row per input row: id, ``log_weight``, ``gumbel_key`` and ``kept``.

    A text's weight is the log ratio of its n-grams under the target model (labelled good rows) and the raw model (all
    rows). The rows with the largest weight plus Gumbel noise are the sample without replacement;
    its size is ``share`` of all rows, by default the share of good rows among the labelled ones.

    Null and empty texts have weight 0 and compete like others. Rows at the cutoff all stay, so equal rows
    fare alike. Without labelled good rows all weights are 0 and all rows stay. Empty tables give empty results;
    columns besides the named ones are not read. The rank comes from a range sort and distributed running sums.
    """
    ranked, cutoff = _sampled(docs, labels, id_col, text_col, label_col, share, buckets, target_rows, seed)[:2]
    return ranked.withColumn("kept", F.col("gumbel_key") >= F.lit(cutoff))


def _sampled(docs, labels, id_col, text_col, label_col, share, buckets, target_rows, seed):
    ratio, good = fit(docs, labels, id_col, text_col, label_col, buckets, target_rows)
    weighed = stored(scored(docs, ratio, id_col, text_col, seed), "quality-scores")
    n = weighed.count()
    take = round((good if share is None else share) * n)
    if take >= n:
        return weighed, float("-inf"), ratio
    if take <= 0:
        return weighed, float("inf"), ratio
    order = running_sum(weighed.select("gumbel_key"), [F.col("gumbel_key")], F.lit(1), "quality-rank")
    # Among equal keys the place is any of theirs; the cutoff is a key, so that does not matter.
    cutoff = order.where(F.col("before") >= n - take).agg(F.min("gumbel_key")).first()[0]
    return weighed, cutoff, ratio


def drop_rejected(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    share: float | None = None, buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``resample`` keeps; they are weighed again instead of being joined."""
    cutoff, ratio = _sampled(docs, labels, id_col, text_col, label_col, share, buckets, target_rows, seed)[1:]
    model = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            key = weights(raw_texts(batch, "_text"), model.value, np.array(batch.column("_noise").to_pylist(), np.int64))[1]
            table = pa.Table.from_batches([batch.select(["_all"])]).filter(pa.array(key >= cutoff)).combine_chunks()
            yield from table.to_batches()

    packed = docs.select(F.struct("*").alias("_all"), F.col(text_col).alias("_text"), F.xxhash64(F.lit(seed), id_col, text_col).alias("_noise"))
    return packed.mapInArrow(run, packed.select("_all").schema).select("_all.*")

"""Toxicity: boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, stored, texts, with_fields

#: Most labelled rows of each class that the lexicon is learned from, and most that trees and calibration see in all.
LEXICON_ROWS, TRAIN_ROWS = 6_000, 60_000
#: Most terms in the learned lexicon, and how many texts a term has to be in.
LEXICON_TERMS, LEAST_TEXTS = 400, 4
PREFIXES = (4, 5, 6)
TREES, DEPTH, STEP, SEED = 24, 4, 0.2, 5
CALIBRATION_PART = 4  # one in four training rows calibrates
CACHED_WORDS = 600_000
WORD = re.compile(r"[^\W_]+")
SIGNS = re.compile(r"[!?]+")
SPACED = re.compile(r"(?<!\w)(?:\w[ .\-*]){3,}\w(?!\w)")
MASKED = re.compile(r"\w[*@$#%]+\w")
LONG_RUN = re.compile(r"(\w)\1\1")
# Insults, second-person words of four languages, and digits and signs read as letters.
INSULTS = "idiot idiots moron stupid dumb scum trash loser worthless pathetic disgusting clown fool jerk imbécile débile stupide dumm idiota estúpido".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes vosotros tus".split()
READ_AS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
NEAR = 8
FEATURES = (
    "hits hit_density distinct_hits weight weight_density heaviest insults insult_density near_person nearest_person person_density "
    "capitals capital_words punctuation exclamations questions sign_runs digit_words masked spaced disguised_hits long_runs word_length "
    "log_words non_ascii distinct_words"
).split()


def terms(word: str) -> set[str]:
    """A word's leading parts: an insult's inflections share them."""
    return {word[:n] for n in PREFIXES if len(word) >= PREFIXES[0]}


class Features:
    """Dense features of whole texts. Weights of words are kept once they are known."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.insults, self.person, self.known = lexicon, set(INSULTS), set(SECOND_PERSON), {}

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def of(self, text: str) -> list[float]:
        low = text.lower()
        words = WORD.findall(low)
        n = max(1, len(words))
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        kinds = set(words)
        for w in kinds.difference(self.known):
            self.known[w] = self.weight(w)
        weights = np.fromiter(map(self.known.__getitem__, words), float, len(words))
        hits = np.flatnonzero(weights)
        insulting = self.insults & kinds
        insults = sum(words.count(w) for w in insulting)
        person = np.array([i for i, w in enumerate(words) if w in self.person] if kinds & self.person else [], np.int64)
        rude = np.union1d(hits, [i for i, w in enumerate(words) if w in insulting]).astype(np.int64) if insulting else hits
        nearest = NEAR * 4.0
        near = 0
        if len(rude) and len(person):
            right = np.clip(np.searchsorted(person, rude), 0, len(person) - 1)
            gaps = np.minimum(np.abs(person[right] - rude), np.abs(person[np.maximum(right - 1, 0)] - rude))
            nearest, near = float(min(gaps.min(), nearest)), int((gaps <= NEAR).sum())
        digits = [w for w in kinds if not w.isalpha() and not w.isdigit()]
        disguised = sum(self.weight(w.translate(READ_AS)) > 0 or w.translate(READ_AS) in self.insults for w in digits)
        masked = MASKED.findall(text)
        spaced = SPACED.findall(text)
        size = max(1, len(text))
        upper = sum(map(str.isupper, text)) if low != text else 0
        marks = size - sum(map(len, words)) - text.count(" ") - text.count("\n")
        shouted = sum(w.isupper() and len(w) > 1 for w in text.split()) if upper > size // 50 else 0
        total = float(weights.sum())
        return [
            len(hits), len(hits) / n, len({words[i] for i in hits.tolist()}), total, total / n, float(weights.max(initial=0)), insults, insults / n,
            near, nearest, len(person) / n, upper / size, shouted / n, marks / size, text.count("!") / n, text.count("?") / n, len(SIGNS.findall(text)) / n,
            len(digits) / n, len(masked) / n, len(spaced) / n, disguised, len(LONG_RUN.findall(low)) / n, sum(map(len, words)) / n, math.log1p(len(words)),
            1 - len(text.encode("ascii", "ignore")) / size, len(kinds) / n,
        ]


def held_out(id_col: str = "doc_id") -> Column:
    """True where labels must not be learned from: the crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _chosen(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, by a hash."""
    return labels.orderBy(F.xxhash64("_label_id", F.lit(SEED)), "_label_id", "_label").limit(rows)


def learn_lexicon(docs: DataFrame, labels: DataFrame, text_col: str, rows: int = LEXICON_ROWS, limit: int = LEXICON_TERMS) -> dict[str, float]:
    """Log odds of the word beginnings that mark toxic texts, from at most ``rows`` labelled texts of each class.

    The chosen ids are broadcast, which their number bounds; tasks add up before they send; at most ``limit`` terms reach the driver.
    """
    picked = stored(_chosen(labels.where("_label = 1"), rows).unionByName(_chosen(labels.where("_label = 0"), rows)), "toxic-picked")
    size = {r[0]: r[1] for r in picked.groupBy("_label").count().collect()}
    sample = docs.join(F.broadcast(picked), F.col("_id") == F.col("_label_id")).select(F.col(text_col).alias("text"), "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(texts(batch, "text"), batch.column("_label").to_pylist(), strict=True):
                counts[label].update(set().union(*map(terms, set(WORD.findall(text.lower())))))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[0][t] for t in names], pa.int64()), pa.array([counts[1][t] for t in names], pa.int64())],
                ["term", "clean", "toxic"],
            )

    counted = sample.mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (size.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (size.get(0, 0) + 1))
    best = counted.where(F.col("toxic") >= LEAST_TEXTS).withColumn("odds", odds).where("odds > 1.5")
    # Frequent and one-sided terms first.
    best = best.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(limit)
    return {r[0]: r[1] for r in best.select("term", "odds").collect()}


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS, trees: int = TREES
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` (0 to 1, calibrated) and ``predicted`` (1 if the score is at least 0.5).

    Labels of held-out ids (crc32 of the id as text a multiple of 5) are never read. A lexicon of word beginnings, boosted
    trees over ``FEATURES`` and an isotonic calibration of the trees' margin are learned from the other labelled rows, at most
    ``train_rows`` of them. Rows that calibrate teach neither lexicon nor trees; only where one part would lack a class do all rows teach all. Inputs of a score are the features of the whole text only.

    Null texts are empty; an empty text has a score like any other. Without labelled rows of both classes, every score
    is the share of toxic labels (0 if there are none). Rows with null labels or null ids teach nothing.
    Repeated rows are scored alike. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    taught = labels.select(F.col(id_col).alias("_label_id"), (F.col(label_col) == 1).cast("int").alias("_label"))
    taught = taught.where(F.col("_label").isNotNull() & F.col("_label_id").isNotNull() & ~held_out("_label_id"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = taught.join(rows.select("_id"), F.col("_id") == F.col("_label_id"), "left_semi")
    calibrating = F.pmod(F.xxhash64("_label_id", F.lit(SEED + 1)), F.lit(CALIBRATION_PART)) == 0
    parts = known.groupBy(calibrating.alias("calibrating"), "_label").count().collect()  # four rows at most
    share = sum(r["count"] for r in parts if r["_label"] == 1) / max(1, sum(r["count"] for r in parts))
    kinds, apart = len({r["_label"] for r in parts}), len(parts) == 4
    if kinds < 2:
        named = rows.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"))
        return named.withColumns({"score": F.lit(float(share)), "predicted": F.lit(int(share >= 0.5))})
    shared = spark.sparkContext.broadcast(Features(learn_lexicon(rows, taught.where(~calibrating) if apart else taught, "_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = shared.value  # one for each worker process, with the weights it has looked up
        for batch in slices(batches, "_text"):
            found = [[float(x) for x in features.of(t)] for t in texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.list_(pa.float64()))], ["_id", "features"])

    dense = stored(rows.mapInArrow(run, with_fields(rows.schema["_id"], "features array<double>")), "toxic-features")
    vectors = dense.withColumn("x", array_to_vector("features"))
    train = vectors.join(F.broadcast(_chosen(taught, train_rows)), F.col("_id") == F.col("_label_id")).select("_label_id", "x", F.col("_label").cast("double").alias("label"))
    train = stored(train, "toxic-train")
    fitted, held = train.where(~calibrating), train.where(calibrating)
    if fitted.agg(F.count_distinct("label")).first()[0] < 2 or held.agg(F.count_distinct("label")).first()[0] < 2:
        fitted = held = train  # too few labels to set some aside
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(fitted)

    def with_margin(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])

    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(with_margin(held).select("margin", "label"))
    scored = isotonic.transform(with_margin(vectors).select("_id", "margin"))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select(
        F.col("_id").alias(id_col), held_out("_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )

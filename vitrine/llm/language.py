"""Language by words first: known words by their frequency in each language, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, stored, texts, with_fields

#: Most labelled rows that are learned from, by a hash of id and text.
TRAIN_ROWS = 5_000
#: Most words, and most n-grams of all lengths, that a model knows: the most frequent ones. They bound what is broadcast.
KNOWN_WORDS, KNOWN_GRAMS = 50_000, 60_000
LONGEST = 5
SMOOTHING = 0.5
#: A worker forgets the words it has scored when it holds this many.
CACHED_WORDS = 600_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")


def word_grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single characters without the marks."""
    marked = word if n == 1 else f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language. ``words`` and ``grams`` map to rows of ``table``."""

    def __init__(self, languages: list[str], words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]]):
        self.languages = languages
        self.words = self._logs(words, [0])
        self.grams = self._logs(grams, range(1, LONGEST + 1))

    def _logs(self, counts: dict[str, dict[str, int]], lengths) -> dict[str, np.ndarray]:
        names = list(counts)
        table = np.array([[counts[x].get(lang, 0) for lang in self.languages] for x in names], float).reshape(len(names), len(self.languages))
        order = np.array([0 if len(lengths) == 1 else len(x) for x in names])
        for n in lengths:  # frequencies among n-grams of the same length
            mine = order == n
            table[mine] = np.log((table[mine] + SMOOTHING) / (table[mine].sum(0) + SMOOTHING * max(1, mine.sum())))
        return dict(zip(names, table, strict=True))

    def score(self, word: str) -> np.ndarray:
        """Log frequencies of one word by language; zeros if nothing about it is known."""
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            found = [self.grams[g] for g in word_grams(word, n) if g in self.grams]
            if found:
                return sum(found[1:], found[0]) / len(found)
        return np.zeros(len(self.languages))


class Predictor:
    """Scores whole texts; words are scored once and kept."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.rows = np.zeros((1 << 12, len(model.languages) + 1))  # log frequencies, and 1 if the word has a letter

    def _learn(self, words: set[str]) -> None:
        while len(self.place) + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for word in words:
            at = self.place[word] = len(self.place)
            self.rows[at, :-1] = self.model.score(word)
            self.rows[at, -1] = any(map(str.isalpha, word))

    def predict(self, text: str) -> tuple[str, float]:
        found = WORD.findall(text.lower())
        if not found or not self.model.languages:
            return UNDETERMINED, 0.0
        new = set(found).difference(self.place)
        if len(self.place) + len(new) > CACHED_WORDS:
            self.place.clear()
            new = set(found)
        self._learn(new)
        total = self.rows.take(np.fromiter(map(self.place.__getitem__, found), np.int64, len(found)), axis=0).sum(0)
        if not total[-1]:
            return UNDETERMINED, 0.0
        logs = total[:-1]
        best = int(np.argmax(logs))
        return self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) over the rows' whole texts; a task adds up before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
                counts.update((lang, w) for w in WORD.findall(text.lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    def sent(counts: Counter) -> pa.RecordBatch:
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                for size in range(1, LONGEST + 1):
                    for gram in word_grams(word, size):
                        counts[lang, gram] += n
            if len(counts) > CACHED_WORDS:
                yield sent(counts)
                counts = Counter()
        yield sent(counts)

    return words.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, limit: int) -> dict[str, dict[str, int]]:
    by_word = counts.groupBy("word").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    return {r[0]: r[1] for r in by_word.orderBy(F.desc("total"), "word").limit(limit).select("word", "by").collect()}


def learning_part(id_col: str = "doc_id"):
    """True where a row may be learned from: the crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS, words: int = KNOWN_WORDS, grams: int = KNOWN_GRAMS) -> Model:
    """A model from rows with a text and a language; at most about ``rows`` of them, chosen by a hash of the text."""
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    n = labelled.count()
    part = F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, rows / max(1, n))))
    sample = labelled.where(part).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = stored(_word_counts(sample), "language-words")
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())
    return Model(languages, _most_frequent(counted, words), _most_frequent(_gram_counts(counted), grams))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score`` (0 to 1: how far the words speak for it) of every row's whole text.

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned. On a tie the first language by
    code point wins. Repeated rows are scored alike; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(Predictor(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = shared.value  # one for each worker process, with the words it has scored
        for batch in slices(batches, "_text"):
            found = [predictor.predict(t) for t in texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                ["_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, with_fields(rows.schema["_id"], "lang_pred string, score double")).withColumnRenamed("_id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Learns from the learning part of ``docs`` and predicts all rows: id, ``held_out``, ``lang_pred``, ``score``."""
    part = learning_part(id_col)
    model = fit(docs.where(part), text_col, lang_col, **options)
    return predict(docs, model, id_col, text_col).select(id_col, F.coalesce(~part, F.lit(False)).alias("held_out"), "lang_pred", "score")

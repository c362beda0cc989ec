"""Token-ID output: texts become ids, ids become range-coded blocks in files, and files become ids again."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import work_dir
from . import rangecode
from .common import slices
from .words import raw_texts

END_ID = 1
BLOCK_IDS = 1 << 21
#: Texts are tokenized word by word; a worker forgets its words when it holds this many.
CACHED_WORDS = 1_000_000
#: New words that one call of the tokenizer takes as a text of their own.
TOGETHER = 200
#: Bytes of a text with blanks for tabs and line ends; and with small letters for A-Z as well.
BLANK = bytes(32 if b in b"\t\n\r" else b for b in range(256))
PLAIN = bytes(b + 32 if 65 <= b <= 90 else BLANK[b] for b in range(256))
#: How byte-level vocabularies write the bytes of small Latin-1 letters that have no printable sign of their own.
BYTE_SIGNS = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
#: Kinds of bytes in plain words: small letters, digits, ASCII signs but the apostrophe and what may open a special token.
KINDS = np.full(256, OTHER, np.uint8)
KINDS[33:127] = SIGN
KINDS[48:58], KINDS[97:123], KINDS[32] = DIGIT, LETTER, SPACE
KINDS[65:91] = KINDS[[39, 60]] = OTHER
WORD_END = "</w>"
#: Texts on which the word-wise way must agree with the library before it is used.
PROBES = (
    "", "  a  b", "<|endoftext|> x <|ENDOFTEXT|>", "It's. 'sound' don't, 3.5, a.b, ÀÉ, Ω. É́. x İstanbul ΣΑΣ. !!, .",
    "é. é, x9. x9,. ,,", "tabs\tand\r\nlines ...  Ends.", "a.,b., c,.", "日本語。 テスト, 1,000.", "wow!!! x*** y$%' (z) é!! 5%, '' rock'n'roll's' a\u0301!!",
    "The Quick brown\u00a0fox, [x]_y^z~{q}|w @home #1 2nd 12:30 naïve façade œuvre straße ÿ÷×",
)


class Words(dict):
    """Words to their numbers; a word that is not there gets the next one."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def plain_pieces(words: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(which words are plain, their pieces as texts of many words, number of pieces of each plain word).

    Plain words need neither normalising nor the tokenizer's own splitting: small Latin-1 letters, digits and signs, cut
    into letters, single digits and runs of signs.
    """
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    kind = KINDS[data]
    # Small letters with accents are two bytes, C3 and 9F to BF without the division sign.
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x9F) & (data[1:] <= 0xBF) & (data[1:] != 0xB7)
    kind[second] = LETTER
    kind[:-1][second[1:]] = LETTER
    space = kind == SPACE
    word = np.cumsum(space) - space
    plain = np.bincount(word[~space], minlength=len(words)) > 0
    plain[word[kind == OTHER]] = False
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] != SPACE) & (kind[:-1] != SPACE) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    kept = plain[word]
    pieces = 1 + np.bincount(word[cut], minlength=len(words))[plain]
    places = np.flatnonzero(cut & kept)
    # A blank before every cut; where it goes among the bytes that stay.
    joined = np.insert(data[kept], np.cumsum(kept)[places] - 1, 32)
    ends = np.flatnonzero(joined == 32)[np.cumsum(pieces) - 1] if len(pieces) else np.zeros(0, np.int64)
    texts, start = [], 0
    for end in ends[[*range(TOGETHER - 1, len(ends), TOGETHER), *([len(ends) - 1] if len(ends) % TOGETHER else [])]]:
        text = joined[start:end].tobytes().decode("latin-1")
        start = end + 1
        if not text.isascii():
            for byte, sign in BYTE_SIGNS.items():
                text = text.replace(byte, sign)
        texts.append(text)
    return plain, texts, pieces


class WordTokenizer:
    """Ids of whole texts, from the ids of their words.

    None of the tokenizer's pre-token patterns crosses white space, so the ids of a text are
    the ids of its white-space separated parts in order. Parts repeat a lot, so their ids are kept, by number, one after
    the other in an array. More parts are alike without capitals: the tokenizer itself lower-cases, so A-Z may be
    lowered first, but for the strings of special tokens. New plain words go to the tokenizer's model many at a time,
    already split; their last piece ends a word. Other words take the tokenizer's whole way.

    Whether all this holds for a file is tried on ``PROBES`` when it is loaded; a tokenizer that gives other ids gets whole texts.

    It travels as a path; each worker process loads the file once and keeps its words from task to task.
    """

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None

    def __getstate__(self):
        return {"path": self.path, "tokenizer": None}

    def load(self) -> int:
        """Size of the vocabulary, once the tokenizer is there."""
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer, normalizers, pre_tokenizers

            self.tokenizer, self.model = Tokenizer.from_file(self.path), Tokenizer.from_file(self.path)
            self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
            self.size = self.tokenizer.get_vocab_size()
            self.code = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
            self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
            self.ends = np.zeros(self.size, bool)
            for piece, i in self.tokenizer.get_vocab().items():
                self.ends[i] = piece.endswith(WORD_END)
            self.plain = self.lowers and bool(self.ends.any())
            self._forget()
            probes = [t.encode() for t in PROBES]
            try:
                self.whole = any(a.tolist() != b.tolist() for a, b in zip(self._by_words(probes), self._whole(probes), strict=True))
            except ValueError:  # pieces and word ends do not fit each other
                self.whole = True
        return self.size

    def _forget(self) -> None:
        self.words, self.used = Words(), 0
        self.ids, self.start, self.length = np.zeros(1 << 16, self.code), np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)

    def _whole(self, batch: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode(errors="replace") for t in batch], add_special_tokens=False)
        return [np.array(code.ids, self.code) for code in found]

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of some new words, one word after the other."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.words) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[numbers], self.length[numbers] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(ids)

    def _learn(self) -> None:
        first, new = len(self.words) - len(self.words.new), self.words.new
        self.words.new = []
        plain, texts, pieces = plain_pieces(new) if self.plain else (np.zeros(len(new), bool), [], np.zeros(0, np.int64))
        numbers = np.arange(first, len(self.words))
        if texts:
            found = self.model.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(code.ids, self.code) for code in found])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != pieces.sum() or ends[-1] != len(ids):
                raise ValueError("pieces and word ends do not fit each other")
            self._keep(numbers[plain], ids, np.diff(ends[np.cumsum(pieces) - 1], prepend=0))
        other = numbers[~plain]
        if len(other):
            found = self._whole([new[i - first] for i in other])
            self._keep(other, np.concatenate(found), np.array([len(x) for x in found]))

    def _by_words(self, batch: list[bytes]) -> list[np.ndarray]:
        if len(self.words) > CACHED_WORDS:
            self._forget()
        parts = [t.translate(PLAIN if self.lowers and b"<|" not in t else BLANK).split(b" ") for t in batch]
        counts = np.array([len(p) for p in parts], np.int64)
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        if self.words.new:
            self._learn()
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        taken = self.ids[np.repeat(self.start[numbers] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        return np.split(taken, np.concatenate([[0], ends])[np.cumsum(counts)[:-1]]) if len(counts) else []

    def encode(self, batch: list[bytes]) -> list[np.ndarray]:
        """The ids of UTF-8 texts."""
        self.load()
        return self._whole(batch) if self.whole else self._by_words(batch)


def write_tokens(
    docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Write the ids of every text, each with ``end_id`` after it, in ascending order of ``id_col`` to ``path``.

    The file format: a Parquet table, one row per block: ``part`` and ``block`` (the order of the blocks),
    ``first`` (ids of the same part before the block), ``ids`` (ids in the block), ``docs`` (document ids), ``lengths`` (ids
    of each document) and ``payload`` (see ``rangecode``). A block holds whole documents, about ``block_ids`` ids or
    one document that is longer. Spark's own committer writes it, so the store needs nothing but Spark, and a
    repeated or lost task leaves no part of a file behind.

    A null text is empty and gives only the end id. A null document id comes first; rows with
    equal ids are ordered by their texts. The tokenizer's file must be readable on the executors.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ordered = rows.repartitionByRange(n, "_id").sortWithinPartitions("_id", "_text").select(F.spark_partition_id().alias("_part"), "_id", "_text")

    shared = docs.sparkSession.sparkContext.broadcast(WordTokenizer(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared.value
        tokenizer.load()
        end = np.array([end_id], "<u4")
        part, block, first = 0, 0, 0
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        lengths: list[int] = []

        def row() -> pa.RecordBatch:
            together = np.concatenate(ids).astype("<u4")
            found = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([len(together)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([rangecode.encode(together, max(tokenizer.size, end_id + 1))], pa.binary()),
                ],
                ["part", "block", "first", "ids", "docs", "lengths", "payload"],
            )

        held = 0
        for batch in slices(batches, "_text"):
            part = batch.column("_part")[0].as_py()
            column = batch.column("_id")
            for i, code in enumerate(tokenizer.encode(raw_texts(batch, "_text"))):
                ids += [code, end]
                names.append(column.slice(i, 1))
                lengths.append(len(code) + 1)
                held += len(code) + 1
                if held >= block_ids:
                    yield row()
                    block, first, held = block + 1, first + held, 0
                    ids, names, lengths = [], [], []
        if ids:
            yield row()

    kind = ordered.schema["_id"].dataType.simpleString()
    schema = f"part int, block int, first long, ids long, docs array<{kind}>, lengths array<long>, payload binary"
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_tokens`` wrote, decoded: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` (with the end
    id), ``ids_crc32`` (of all these ids as little-endian 32-bit integers) and ``ids``.

    A block whose checksum does not hold raises ``rangecode.CorruptBlock``. An empty table has no rows. Only one total per part is brought
    together, to shift the starts; parts are as many as the writer had partitions.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("ids").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    placed = blocks.join(F.broadcast(shifts), "part").select((F.col("first") + F.col("_shift")).alias("_start"), "docs", "lengths", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = rangecode.decode(batch.column("payload")[i].as_py())
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                if len(lengths) and int(ends[-1]) != len(ids):
                    raise rangecode.CorruptBlock("the lengths do not add up to the block")
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("docs")[i].values, pa.array(starts + batch.column("_start")[i].as_py(), pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view("<i4"), pa.int32())),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, ids array<int>")


def tokenized(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the ids to a fresh folder in the shared work folder and read them back."""
    path = work_dir(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path, **options)
    return read_tokens(docs.sparkSession, path)

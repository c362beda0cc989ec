"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, with_fields
from .words import ORIGINAL, raw_texts, words

WINDOW = 10
#: Benchmark text per automaton. A larger benchmark is dealt to several automata, over which the texts pass in turn.
AUTOMATON_BYTES = 1 << 20


class Matcher:
    """The windows of some items. Travels as texts; the automaton is built once per worker process."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items, self.window, self.ready = items, window, None

    def __getstate__(self):
        return {"items": self.items, "window": self.window, "ready": None}

    def build(self):
        """(word numbers, automaton over sequences of them, items of each window)."""
        if self.ready is None:
            numbers: dict[bytes, int] = {}
            owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
            for item, text in self.items:
                sequence = [numbers.setdefault(w, len(numbers) + 1) for w in words(text)]
                for i in range(max(1, len(sequence) - self.window + 1)) if sequence else ():
                    owners[tuple(sequence[i : i + self.window])].add(item)
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, names in owners.items():
                automaton.add_word(key, (len(key), names))
            if owners:
                automaton.make_automaton()
            self.ready = numbers, automaton if owners else None
        return self.ready

    def find(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words that lie in some window, merged, and the items whose windows occur."""
        numbers, automaton = self.build()
        if automaton is None or not tokens:
            return [], set()
        found: set[str] = set()
        ranges: list[tuple[int, int]] = []
        get = numbers.get
        for end, (length, names) in automaton.iter(tuple([get(w, 0) for w in tokens])):
            found |= names
            ranges.append((end - length + 1, end + 1))
        return merged(ranges), found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def matchers(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> list:
    """Broadcast matchers over all items, each over about ``limit`` bytes of text by the hash of the item."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // limit))
    part = F.pmod(F.xxhash64("item"), F.lit(n))
    return [
        spark.sparkContext.broadcast(Matcher([(r[0], r[1].encode()) for r in items.where(part == i).collect()], window))
        for i in range(n)
    ]


SPANS = "array<struct<start:int,end:int,first_word:int,last_word:int>>"
CARRIED = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _pass(matcher, text_col: str):
    """Adds the ranges and items of one matcher to those carried in ``_ranges`` and ``_items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher.value
        for batch in slices(batches, text_col):
            ranges, items = [], []
            carried = zip(batch.column("_ranges").to_pylist(), batch.column("_items").to_pylist(), strict=True)
            for text, (before, names) in zip(raw_texts(batch, text_col), carried, strict=True):
                found, hit = own.find(words(text))
                ranges.append([{"a": a, "b": b} for a, b in merged([(r["a"], r["b"]) for r in before] + found)])
                items.append(sorted({*names, *hit}))
            out = {n: batch.column(n) for n in batch.schema.names} | {"_ranges": pa.array(ranges, CARRIED), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _carry(docs: DataFrame, text_col: str, found: list) -> DataFrame:
    """Rows with what all matchers but the last one found."""
    df = docs.withColumns({"_ranges": F.lit(None).cast("array<struct<a:int,b:int>>"), "_items": F.lit(None).cast("array<string>")})
    df = df.withColumns({"_ranges": F.coalesce("_ranges", F.array().cast("array<struct<a:int,b:int>>")), "_items": F.coalesce("_items", F.array().cast("array<string>"))})
    for matcher in found[:-1]:
        df = df.mapInArrow(_pass(matcher, text_col), df.schema)
    return df


def scan(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Where windows of benchmark items occur: id, ``n_words``, ``n_hit``, ``items`` (ids as strings, sorted) and ``spans``.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window. A word inside any occurrence counts once in ``n_hit``. ``spans`` are
    the merged stretches of such words: code points of the original text (end excluded) and word numbers.

    Null and empty texts have no words and no hits. A null item id counts as the id ''. Repeated items and
    rows are as good as one; repeated documents each give a row. An empty benchmark hits nothing.
    Columns besides the id and the text are not read, so their names cannot clash.

    Every text passes once per automaton, and there is one automaton per ``automaton_bytes`` of benchmark text,
    which bounds each broadcast. No shuffle.
    """
    found = matchers(benchmark, item_col, item_text_col, window, automaton_bytes)
    last = found[-1]
    rows = _carry(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = last.value
        for batch in slices(batches, "_text"):
            n_words, n_hit, items, spans = [], [], [], []
            columns = [batch.column(n).to_pylist() for n in ("_ranges", "_items")]
            for text, before, names in zip(raw_texts(batch, "_text"), *columns, strict=True):
                tokens = words(text)
                ranges, hit = own.find(tokens)
                ranges = merged([(r["a"], r["b"]) for r in before] + ranges)
                n_words.append(len(tokens))
                n_hit.append(sum(b - a for a, b in ranges))
                items.append(sorted({*names, *hit}))
                spans.append(_original(text, ranges) if ranges else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "first_word", "last_word")]))),
                ],
                ["_id", "n_words", "n_hit", "items", "spans"],
            )

    schema = with_fields(rows.schema["_id"], f"n_words long, n_hit long, items array<string>, spans {SPANS}")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def _original(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    places = np.array([m.span() for m in ORIGINAL.finditer(text.decode())])
    return [
        {"start": int(places[a, 0]), "end": int(places[b - 1, 1]), "first_word": a, "last_word": b - 1} for a, b in ranges
    ]


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark occurs."""
    out = docs
    for matcher in matchers(benchmark, item_col, item_text_col, window, automaton_bytes):
        out = out.mapInArrow(_clean(matcher, text_col), docs.schema)
    return out


def _clean(matcher, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher.value
        for batch in slices(batches, text_col):
            keep = [not own.find(words(text))[1] for text in raw_texts(batch, text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


_SQL_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[k:k + 9], ' ') AS gram, len(w[k:k + 9]) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
occ AS (SELECT doc_id, k, n, gram FROM places SEMI JOIN win USING (gram, n)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM occ) GROUP BY doc_id
),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM occ JOIN win USING (gram, n)) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

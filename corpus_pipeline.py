"""A corpus pipeline over ``documents``: from raw texts to range-coded token ids.

Every stage but the last returns the columns of ``documents``; each works on all rows that its predecessor kept.
Nulls in any column, empty and very long texts, repeated rows and empty tables are handled as the stages' operators
say. SQL cannot express the stages, so the tests compare each with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontaminate, mixing, neardup, quality, tokens
from vitrine.llm.common import stored
from vitrine.llm.queries import table

ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling; the documents that it rejects go."""
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return neardup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to the target weights, documents repeated by epoch."""
    return mixing.mix_sources(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in blocks and read back: a row per document with its place, its number of ids and their crc32."""
    return tokens.tokenized(docs, public_tokenizers.path(TOKENIZER)).drop("ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mix sources", mix),
    ("token output", write_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

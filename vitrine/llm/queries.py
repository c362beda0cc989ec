"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, exact, hardneg, language, licenses, lines, mixing, neardup, quality, repair, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_mix_sources", mixing.SQL)
def op1(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_decontaminate", decontaminate.SQL)
def op2(spark, sf_dir):
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_quality")
def op3(spark, sf_dir):
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_licenses")
def op4(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op5_line_dedup")
def op5(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_near_dedup")
def op7(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("_hash")


@query("op8_exact_dedup", exact.SQL)
def op8(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op9_token_output")
def op9(spark, sf_dir):
    return tokens.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@query("op10_language")
def op10(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op11_chat_format", chat.SQL)
def op11(spark, sf_dir):
    rows = chat.with_minus_one(spark, table(spark, sf_dir, "conversations"))
    back = chat.read_back(chat.format_conversations(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op12_structure_repair")
def op12(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    fixed = repair.repair(repair.damage(rows), rows)
    return fixed.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2("repaired", 256).alias("repaired_sha256"),
    )


@query("op13_hard_negatives", hardneg.SQL)
def op13(spark, sf_dir):
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.integer_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", noisy)
    return hardneg.mine(rows, rows.where("id % 50 = 0")).drop("positive_rank")

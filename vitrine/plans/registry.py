"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir
from .inputs import INPUT_SQL, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_INPUT_NAME = re.compile(r"\bf_\w+")


def with_inputs(sql: str) -> str:
    """Prefix a query with the derived inputs it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(_INPUT_NAME.findall(text))):
            if name in INPUT_SQL and name not in needed:
                visit(INPUT_SQL[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    # Materialized, so that a check cannot multiply an input by joining it late.
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({INPUT_SQL[n].strip()})" for n in needed)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame``, with its check when SQL can express it."""

    def register(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Inputs(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines; -0.0 becomes 0.0."""
    return df.selectExpr(
        *[f"round({c}, {digits}) + 0D AS {c}" if c in columns else f"`{c}`" for c in df.columns]
    )


def text_time(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, which engines compare alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small result that several plans read, and read it back."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""What a task holds at a time and what is sent between tasks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vitrine.operators import blocks, infer, retrieve
from vitrine.plans.models import text_encoder



def test_a_model_gets_few_rows_at_a_time(spark):
    seen = lambda batches: (pd.DataFrame({"doc_id": b["doc_id"], "embedding": [[float(len(b))]] * len(b)}) for b in batches)
    items = spark.range(3000).selectExpr("id AS doc_id", "concat('word ', id) AS text").coalesce(1)
    nothing = spark.createDataFrame([], "doc_id long, encoder_uri string")
    made = infer.embed_incremental(items, nothing, seen, "m", "doc_id", ["text"])
    row = made.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"), F.max(F.col("embedding")[0]).alias("most")).first()
    assert (row["n"], row["ids"]) == (3000, 3000) and row["most"] <= infer.MODEL_ROWS
    assert infer.embed_incremental(items, nothing, text_encoder, "m", "doc_id", ["text"]).schema["embedding"].dataType.simpleString() == "array<double>"


def test_crowded_buckets_send_a_vector_once(spark):
    rng = np.random.RandomState(3)
    rows = [(n, "ab"[n % 3 == 0], [float(x) for x in rng.standard_normal(6)]) for n in range(240)]
    catalogue = spark.createDataFrame([*rows, (900, "a", None)], "product_id long, category string, embedding array<double>")
    queries = catalogue.withColumnRenamed("product_id", "query_id").where("query_id % 4 = 0")
    given = dict(dim=6, bits=3, tables=2, probes=4)
    got = retrieve.ann_topk(queries, catalogue, 5, query_block=16, catalogue_block=16, **given)
    assert "lsh_table" not in got._jdf.queryExecution().analyzed().toString()
    # The pairs that share a bucket, listed.
    c, q = retrieve.with_buckets(catalogue, "product_id", 6, 3, 2), retrieve.with_buckets(queries, "query_id", 6, 3, 2, 4)
    met = {tuple(r) for r in q.join(c, ["category", "lsh_table", "lsh_bucket"]).select("query_id", "product_id").distinct().collect()}
    exact = retrieve.exact_topk(queries, catalogue, 1000).collect()
    want = {}
    for r in sorted(exact, key=lambda r: r["rank"]):
        if (r["query_id"], r["product_id"]) in met and len(want.setdefault(r["query_id"], [])) < 5:
            want[r["query_id"]].append(r["product_id"])
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append(r["product_id"])
    assert found == want and len(met) < len(exact)


def test_blocks_of_both_sides_are_alike():
    rows = blocks.QUERY_BLOCK + blocks.CATALOGUE_BLOCK
    assert rows <= 16_384 and 1 / blocks.QUERY_BLOCK + 1 / blocks.CATALOGUE_BLOCK <= 4 / rows
    unit, keep = blocks._unit_rows(m := np.ones((5, 4)))
    assert len(keep) == 5 and not np.shares_memory(unit, m) and (m == 1).all()

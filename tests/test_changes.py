import random

import pytest
from pyspark.sql import functions as F

from vitrine.streaming import changes as C

SCHEMA = "id long, seq long, op string, text string"
VECTORS = "id long, n int"


def embed(items):
    """The length of the text; empty texts cannot be read."""
    return items.where("text <> ''").select("id", F.length("text").alias("n"))


def deliver(spark, folder, n, rows):
    """Adds a delivery and folds it; the table after it as {id: (n, seq)}."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part{n}")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/part*")
    vectors = spark.createDataFrame([], VECTORS).schema
    table = C.apply_changes(stream, f"{folder}/table", embed, vectors, "id")
    found = table.collect()
    assert len({r.id for r in found}) == len(found)
    return {r.id: (r.n, r.seq) for r in found}


def test_updates_and_deletes_reach_the_table_late_ones_do_not(spark, tmp_path):
    folder = str(tmp_path)
    assert deliver(spark, folder, 0, [(1, 1, "upsert", "a"), (2, 1, "upsert", "bb"), (3, 1, "upsert", "ccc")]) == {1: (1, 1), 2: (2, 1), 3: (3, 1)}
    # Updated, deleted; 4 is deleted before its insert arrives.
    assert deliver(spark, folder, 1, [(1, 5, "upsert", "aaaa"), (2, 3, "delete", None), (4, 9, "delete", None)]) == {1: (4, 5), 3: (3, 1)}
    assert deliver(spark, folder, 2, [(1, 4, "upsert", "old"), (2, 2, "upsert", "old"), (4, 8, "upsert", "old")]) == {1: (4, 5), 3: (3, 1)}
    assert deliver(spark, folder, 3, [(2, 10, "upsert", "back"), (3, 2, "upsert", "")]) == {1: (4, 5), 2: (4, 10)}


def test_ties_and_repeated_changes(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(1, 1, "upsert", "a")] * 3 + [(2, 7, "upsert", "b"), (2, 7, "delete", None), (3, 1, "upsert", "xx"), (3, 1, "upsert", "yyy")]
    first = deliver(spark, folder, 0, rows)
    assert first[1] == (1, 1) and 2 not in first and first[3] in {(2, 1), (3, 1)}
    # A known number counts again only as a delete.
    again = deliver(spark, folder, 1, [(1, 1, "delete", None), (2, 7, "upsert", "b"), (3, 1, "upsert", "zzzz")])
    assert again == {3: first[3]}


def test_bad_changes_are_set_aside(spark, tmp_path):
    folder = str(tmp_path)
    bad = [(None, 1, "upsert", "a"), (1, None, "upsert", "a"), (1, 2, "merge", "a"), (1, 3, None, "a"), (1, 2**62, "upsert", "a")]
    assert deliver(spark, folder, 0, [*bad, (1, 1, "upsert", "kept"), (2, -(2**62), "upsert", "low")]) == {1: (4, 1), 2: (3, -(2**62))}
    schema = spark.createDataFrame([], SCHEMA).schema
    aside = C.rejected_changes(spark, f"{folder}/table", schema).drop("batch").collect()
    assert sorted(map(tuple, aside), key=repr) == sorted(bad, key=repr)
    assert deliver(spark, folder, 1, []) == {1: (4, 1), 2: (3, -(2**62))}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_deliveries_gives_the_same_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = [(k, s, rng.choice(["upsert", "upsert", "delete"]), "x" * rng.randrange(4)) for k in range(12) for s in range(6)]
    last = {k: max((r for r in log if r[0] == k), key=lambda r: r[1]) for k in range(12)}
    want = {k: (len(t), s) for k, (_, s, op, t) in last.items() if op == "upsert" and t}
    rng.shuffle(log)
    got = [deliver(spark, str(tmp_path), n, log[24 * n : 24 * n + 24]) for n in range(3)]
    assert got[-1] == want


def test_only_newer_upserts_are_embedded(spark, tmp_path):
    asked = []

    def counting(items):
        asked.append(sorted(r.id for r in items.collect()))
        return embed(items)

    vectors = spark.createDataFrame([], VECTORS).schema
    for n, rows in enumerate([[(1, 2, "upsert", "a"), (2, 2, "upsert", "b")], [(1, 1, "upsert", "a"), (2, 3, "upsert", "b"), (3, 1, "delete", None)]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part{n}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/part*")
        C.apply_changes(stream, f"{tmp_path}/table", counting, vectors, "id")
    assert asked == [[1, 2], [2]]

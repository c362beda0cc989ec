import numpy as np
import pytest

from vitrine.operators import curate, retrieve
from vitrine.operators.blocks import block_duplicates, block_topk, merge_topk

DIM = 8


def frame(spark, ids, keys, matrix, id_name):
    rows = [(i, k, [float(x) for x in v]) for i, k, v in zip(ids, keys, matrix)]
    id_type = "string" if isinstance(ids[0], str) else "long"
    return spark.createDataFrame(rows, f"{id_name} {id_type}, category string, embedding array<double>")


def skewed(n, seed, share=0.6):
    """Most rows under one key, every seventh vector a copy of the first."""
    rng = np.random.RandomState(seed)
    m = rng.standard_normal((n, DIM))
    m[::7] = m[0]
    keys = np.where(rng.rand(n) < share, "hot", rng.choice(["a", "b"], n))
    return keys.tolist(), m


def brute_force(q_ids, q_keys, q, p_ids, p_keys, p, k, score):
    out = {}
    for i, key, v in zip(q_ids, q_keys, q):
        scored = [(-round(score(v, w), 12), pid) for pid, pk, w in zip(p_ids, p_keys, p) if pk == key]
        out[i] = [pid for _, pid in sorted(scored)[:k]]
    return out


def cosine(a, b):
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["product_id"])
    return out


@pytest.mark.parametrize("small_limit", [10_000, 0])
@pytest.mark.parametrize("blocks", [(2048, 8192), (7, 11)])
def test_topk_equals_brute_force_on_a_hot_key(spark, blocks, small_limit):
    q_keys, q = skewed(60, 1)
    p_keys, p = skewed(150, 2)
    expected = brute_force(range(60), q_keys, q, range(150), p_keys, p, 9, cosine)
    got = retrieve.exact_topk(
        frame(spark, list(range(60)), q_keys, q, "query_id"), frame(spark, list(range(150)), p_keys, p, "product_id"), 9,
        query_block=blocks[0], catalogue_block=blocks[1], small_limit=small_limit,
    )
    assert lists(got) == expected


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_topk_does_not_depend_on_partitioning(spark, partitions):
    keys, m = skewed(90, 5)
    ids = [f"p{n:03d}" for n in range(90)]
    queries = frame(spark, ids, keys, m, "query_id").repartition(int(partitions))
    catalogue = frame(spark, ids, keys, m, "product_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = lists(retrieve.exact_topk(queries, catalogue, 5, query_block=16, catalogue_block=16))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_force(ids, keys, m, ids, keys, m, 5, cosine)


def test_missing_zero_and_unmatched_vectors(spark):
    queries = spark.createDataFrame(
        [(1, "a", [1.0, 0.0]), (2, "a", None), (3, "a", [0.0, 0.0]), (4, "nowhere", [1.0, 0.0])], "query_id int, category string, embedding array<double>"
    )
    catalogue = spark.createDataFrame(
        [(10, "a", [1.0, 1.0]), (11, "a", [0.0, 0.0]), (12, "a", None)], "product_id int, category string, embedding array<double>"
    )
    assert lists(retrieve.exact_topk(queries, catalogue, 5)) == {1: [10]}


def test_mixed_dimensions_are_an_error(spark):
    queries = spark.createDataFrame([(1, "a", [1.0, 0.0])], "query_id int, category string, embedding array<double>")
    catalogue = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [1.0])], "product_id int, category string, embedding array<double>")
    with pytest.raises(Exception, match="different dimensions"):
        retrieve.exact_topk(queries, catalogue, 1).collect()


def test_hamming_counts_differing_signs(spark):
    keys, m = skewed(40, 9)
    df = frame(spark, list(range(40)), keys, m, "query_id")
    bits = df.withColumn("embedding", retrieve.V.sign_bits("embedding", DIM))
    found = block_topk(bits, bits.withColumnRenamed("query_id", "product_id"), 6, ["category"], metric="hamming", catalogue_block=9)
    expected = brute_force(range(40), keys, m, range(40), keys, m, 6, lambda a, b: -float(((a > 0) != (b > 0)).sum()))
    assert lists(merge_topk(found, 6)) == expected


@pytest.mark.parametrize("block", [8192, 10])
@pytest.mark.parametrize("as_text", [False, True])
def test_duplicates_equal_brute_force(spark, block, as_text):
    keys, m = skewed(120, 4)
    ids = [f"p{n:03d}" for n in range(120)] if as_text else list(range(120))
    got = {r["drop_id"] for r in block_duplicates(frame(spark, ids, keys, m, "product_id"), 0.8, ["category"], block=block).collect()}
    expected = {
        ids[b] for b in range(120) for a in range(b) if keys[a] == keys[b] and round(cosine(m[a], m[b]), 12) >= 0.8
    }
    assert got == expected


def test_two_stage_filters_blends_and_ranks(spark):
    queries = spark.createDataFrame([(1, "bag", [1.0, 0.0, 0.0])], "query_id int, category string, embedding array<double>")
    catalogue = spark.createDataFrame(
        [
            (1, "bag", [1.0, 0.0, 0.0], True, "KR", None), (2, "bag", [0.9, 0.1, 0.0], True, "KR", 1.0),
            (3, "bag", [1.0, 0.0, 0.0], False, "KR", 1.0), (4, "hat", [1.0, 0.0, 0.0], True, "KR", 1.0), (5, "bag", [1.0, 0.0, 0.0], True, "JP", 1.0),
        ],
        "product_id int, category string, embedding array<double>, in_stock boolean, region string, business_score double",
    )
    got = retrieve.two_stage_search(queries, catalogue, 10, 2, 5, 0.15, region="KR").orderBy("rank").collect()
    assert [(r["rank"], r["product_id"]) for r in got] == [(1, 2), (2, 1)]
    assert got[1]["score"] == pytest.approx(0.85)
    everywhere = retrieve.two_stage_search(queries, catalogue, 10, 2, 5, 0.15, in_stock_only=False).collect()
    assert {r["product_id"] for r in everywhere} == {1, 2, 3, 5}


def test_items_of_unknown_category_search_everything(spark):
    items = spark.createDataFrame(
        [(7, 0, "bag", [1.0, 0.0]), (7, 1, "scarf", [0.0, 1.0]), (8, 0, None, [1.0, 0.0])], "image_id long, item_index int, category string, embedding array<double>"
    )
    catalogue = spark.createDataFrame([(1, "bag", [0.0, 1.0]), (2, "hat", [1.0, 0.0])], "product_id int, category string, embedding array<double>")
    got = {(r["image_id"], r["item_index"], r["rank"]): r["product_id"] for r in retrieve.multi_item_search(items, catalogue, 5).collect()}
    assert got == {(7, 0, 1): 1, (7, 1, 1): 1, (7, 1, 2): 2, (8, 0, 1): 2, (8, 0, 2): 1}


def test_hashed_search_is_a_part_of_the_exact_one(spark):
    keys, m = skewed(200, 11)
    catalogue = frame(spark, list(range(200)), keys, m, "product_id")
    queries = frame(spark, list(range(200)), keys, m, "query_id")
    ann = retrieve.ann_topk(queries, catalogue, 5, DIM, bits=3, tables=8, probes=4)
    recall = retrieve.recall_against(retrieve.exact_topk(queries, catalogue, 5), ann).first()["recall"]
    assert 0.9 <= recall <= 1.0
    complete = retrieve.ann_topk(queries, catalogue, 5, DIM, bits=1, tables=1, probes=2)
    assert lists(complete) == lists(retrieve.exact_topk(queries, catalogue, 5))


def test_newest_vector_per_product(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "product_id int, v string, embedded_at int")
    assert {(r["product_id"], r["v"]) for r in retrieve.latest_vectors(df).collect()} == {(1, "b"), (2, "d")}


def test_hit_report(spark):
    results = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 3, 20)], "query_id int, rank int, product_id int")
    judged = spark.createDataFrame([(1, 11), (2, 20), (3, 30)], "query_id int, product_id int")
    r = retrieve.hit_report(results, judged).first()
    assert (r["n_queries"], r["n_hits"], r["hit_rate"], r["median_rank"]) == (3, 2, pytest.approx(2 / 3), 2)


def test_finer_key_inside_blocks_equals_it_as_a_key(spark):
    keys, m = skewed(150, 21)
    df = frame(spark, list(range(150)), ["all"] * 150, m, "query_id").join(
        spark.createDataFrame([(n, {"hot": 0, "a": 1, "b": 2}[k]) for n, k in enumerate(keys)], "query_id long, fine int"), "query_id"
    )
    products = df.withColumnRenamed("query_id", "product_id")
    got = block_topk(df, products, 7, ["category"], within="fine", query_block=20, catalogue_block=30)
    assert lists(merge_topk(got, 7)) == brute_force(range(150), keys, m, range(150), keys, m, 7, cosine)
    dups = lambda **how: {r["drop_id"] for r in block_duplicates(products, 0.8, block=25, **how).collect()}
    assert dups(keys=["category"], within="fine") == dups(keys=["category", "fine"])


def test_hashed_duplicates_are_right_and_find_close_copies(spark):
    rng = np.random.RandomState(3)
    m = rng.standard_normal((120, DIM))
    m = np.vstack([m, m + 0.02 * rng.standard_normal(m.shape)])
    df = frame(spark, list(range(240)), ["c"] * 240, m, "product_id")
    exact = {r["drop_id"] for r in curate.near_duplicates(df, 0.97).collect()}
    hashed = {r["drop_id"] for r in curate.near_duplicates_hashed(df, DIM, 0.97, bits=6, tables=20).collect()}
    assert hashed <= exact and set(range(120, 240)) <= hashed


def test_pivot_angles_leave_out_no_pair():
    from vitrine.operators.blocks import _near_cells

    rng = np.random.RandomState(11)
    centres = rng.standard_normal((60, 16))
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    for noise, most in ((0.05, 0.3), (0.4, 1.0), (3.0, 1.0)):
        a, b = (unit(centres[rng.randint(60, size=n)] + noise * rng.standard_normal((n, 16))) for n in (1500, 2300))
        b[:40] = a[:40]
        seen = np.zeros((len(a), len(b)), dtype=np.int64)
        for rows, cols in _near_cells(a, b, 0.97):
            seen[np.ix_(rows, cols)] += 1
        assert seen.max() == 1
        assert (seen[(a @ b.T) >= 0.97] == 1).all()
        assert seen.mean() <= most


def test_items_with_null_ids_keep_their_rankings(spark):
    _, m = skewed(30, 12)
    catalogue = frame(spark, list(range(30)), ["x"] * 30, m, "product_id")
    items = [(None, 1, "x"), (None, None, "x"), ("7", None, "x"), ("7", 2, None), ("#3#", 0, "x")]
    rows = [(a, b, c, [float(x) for x in m[n + 5]]) for n, (a, b, c) in enumerate(items)]
    df = spark.createDataFrame(rows, "image_id string, item_index int, category string, embedding array<double>")
    got = {(r["image_id"], r["item_index"]): r["product_id"] for r in retrieve.multi_item_search(df, catalogue, 1).collect()}
    best = [int(np.argmax([round(cosine(m[n + 5], v), 12) for v in m])) for n in range(5)]
    assert got == {(a, b): best[n] for n, (a, b, _) in enumerate(items)}

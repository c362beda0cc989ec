"""Hard negatives beside scoring everything."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from vitrine.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, block long, dim string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def plain(rows, positives=5, negatives=3, low=50, high=95, anchor=lambda i: i % 5 == 0):
    """(anchor, positive rank, positive, rank, negative, scores) by scoring all pairs."""
    part = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**23 for x in v):
            q = [math.floor(256 * float(np.float32(x))) for x in v]
            if sum(x * x for x in q) < 2**62:
                part.append((i, label, q))
    last = lambda i: math.inf if i is None else i
    anchors = {}
    for i, label, q in part:
        if i is not None and anchor(i) and (i not in anchors or (label, len(q), q) < anchors[i]):
            anchors[i] = (label, len(q), q)
    out = []
    for a, (label, dim, q) in anchors.items():
        scores = [(-sum(x * y for x, y in zip(q, w)), last(i), i, other) for i, other, w in part if len(w) == dim]
        best = sorted(s for s in scores if s[3] == label and s[2] != a)[:positives]
        for p, (minus, _, pid, _) in enumerate(best, 1):
            inside = sorted(s for s in scores if s[3] != label and low * -minus <= 100 * -s[0] <= high * -minus)
            out += [(a, p, pid, r, s[2], -minus, -s[0]) for r, s in enumerate(inside[:negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    whole = hardneg.integer_rows(table(spark, rows), "vec_id", "embedding", F.col("label"))
    df = hardneg.mine(whole, whole.where("id % 5 = 0"), **options)
    columns = ["anchor_id", "positive_rank", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def vectors(seed, n, dim, labels, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        rows.append((i, [float(x) for x in centres[label] + spread * rng.normal(size=dim)], label))
    return rows


@pytest.mark.parametrize("seed,spread", [(1, 0.05), (2, 1.0)])
def test_equals_scoring_everything(spark, seed, spread):
    rows = vectors(seed, 400, 6, 4, spread)
    rows += [(1000 + i, *rows[i][1:]) for i in range(60)]  # copies: ties
    assert mined(spark, rows, anchor_block=16, candidate_block=50) == plain(rows)
    assert mined(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 60, 4, 3, 0.3)
    rows += [
        (None, [1.0, 0.5, 0.2, 0.1], 1), (None, [1.0, 0.5, 0.2, 0.1], 1), (70, None, 1), (71, [1.0] * 4, None), (75, [1.0, None, 0.0, 0.0], 1),
        (80, [nan, 0.0, 0.0, 0.0], 1), (85, [inf, 0.0, 0.0, 0.0], 1), (90, [1e30, 0.0, 0.0, 0.0], 1), (95, [4e6, 4e6, -4e6, 4e6], 1),
        (96, [4e6, 4e6, -4e6, 3e6], 1), (97, [3e6, 2e6, -2e6, 3e6], 2), (100, [], 1), (101, [], 1), (102, [], 2), (105, [1.0], 1), (106, [0.5], 1), (107, [0.4], 2),
        (110, [0.0] * 4, 1), (5, *rows[5][1:]), (5, *rows[5][1:]), (10, [0.1, 0.2, 0.3, 0.4], 0),
    ]
    want = plain(rows)
    assert want and any(r[0] == 95 for r in want) and any(r[0] == 105 for r in want)
    assert mined(spark, rows) == want
    assert mined(spark, rows, anchor_block=3, candidate_block=7) == want
    assert mined(spark, []) == []
    assert mined(spark, [(5, [1.0], 1)]) == []


def test_bounds_leave_most_rows_unscored():
    rows = vectors(4, 3000, 16, 6, 0.02)
    q = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    block = pa.table({"id": [r[0] for r in rows[:200]], "label": [r[2] for r in rows[:200]], "v": pa.array(q[:200], pa.list_(pa.int32()))})
    planted = hardneg._plant(block)
    assert planted.column("up").to_pylist().count(-1) == 1
    assert all(up < place for up, place in zip(planted.column("up").to_pylist(), planted.column("place").to_pylist()))
    walk = hardneg.Walk(planted, pa.table({"v": pa.array(q, pa.list_(pa.int32()))}))
    seen, total = [], 0

    def wanted(i, low, high, tile):
        return high >= 0.99 * 256 * 256 * 16

    def found(i, picked, scores):
        exact = walk.rows[picked] @ walk.anchors[i]
        assert (exact == scores).all()
        seen.append(len(picked))

    walk.run(wanted, found)
    assert walk.scored < 0.5 * 200 * 3000

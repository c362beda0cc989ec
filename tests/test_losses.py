import math

import pytest

from vitrine.operators import losses


@pytest.fixture
def pairs(spark):
    rows = [(n, [math.sin(n * 3 + d) for d in range(6)], [math.sin(n * 3 + d + 0.2 * d) for d in range(6)], [[math.cos(n + m + d) for d in range(6)] for m in range(2)]) for n in range(12)]
    return spark.createDataFrame(rows, "pair_id int, anchor array<double>, positive array<double>, negatives array<array<double>>")


def cos(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def one_batch(pairs, loss, negatives=None):
    r = losses.loss_report(losses.batch_losses(pairs, loss, 1, negatives)).first()
    assert (r["n_batches"], r["n_pairs"]) == (1, 12)
    return r["loss"]


def nce(rows, dims=6, extra=False):
    a, p = [r["anchor"][:dims] for r in rows], [r["positive"][:dims] for r in rows]
    z = [[cos(x, y) / 0.07 for y in p] for x in a]
    more = [[cos(r["anchor"][:dims], n[:dims]) / 0.07 for n in r["negatives"]] if extra else [] for r in rows]
    lse = lambda v: math.log(sum(math.exp(x) for x in v))
    forward = sum(lse(z[i] + more[i]) - z[i][i] for i in range(len(rows))) / len(rows)
    back = sum(lse([z[i][j] for i in range(len(rows))]) - z[j][j] for j in range(len(rows))) / len(rows)
    return forward if extra else (forward + back) / 2


def test_symmetric_cross_entropy(pairs):
    assert one_batch(pairs, losses.info_nce()) == pytest.approx(nce(pairs.collect()))


def test_pairwise_sigmoid(pairs):
    rows = pairs.collect()
    total = 0.0
    for i, r in enumerate(rows):
        for j, s in enumerate(rows):
            z = cos(r["anchor"], s["positive"]) / 0.07 - 10.0
            total += math.log1p(math.exp(-z if i == j else z))
    assert one_batch(pairs, losses.sig_lip()) == pytest.approx(total / len(rows))


def test_hard_negatives(pairs):
    assert one_batch(pairs, losses.hard_negative_nce(), "negatives") == pytest.approx(nce(pairs.collect(), extra=True))


def test_nested_dimensions(pairs):
    rows = pairs.collect()
    weights = {d: 1 / math.sqrt(d) for d in (2, 6)}
    expected = sum(w * nce(rows, d) for d, w in weights.items()) / sum(weights.values())
    assert one_batch(pairs, losses.matryoshka(losses.info_nce(), (6, 2))) == pytest.approx(expected)


def test_batches_cover_every_pair_once(pairs):
    per_batch = losses.batch_losses(pairs, losses.info_nce(), 4).collect()
    assert sum(r["n_pairs"] for r in per_batch) == 12 and len(per_batch) > 1

import random

import numpy as np
import pytest

from vitrine.llm import neardup as N
from vitrine.llm.words import hashed_words

from .helpers import awkward, docs, plain, words


def distance(a, b):
    row = np.arange(len(b) + 1)
    b = np.asarray(b)
    for i, x in enumerate(a):
        new = np.concatenate([[i + 1], np.minimum(row[1:] + 1, row[:-1] + (b != x))])
        steps = np.arange(len(new))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def test_words_and_offsets():
    texts = ["", "Ab-c é1", "   ", "x" * 50 + " y", "A b\nC"]
    hashes, at = hashed_words([t.encode() for t in texts])
    assert list(np.diff(at)) == [len(words(t)) for t in texts]
    assert len(set(hashes.tolist())) == len({w for t in texts for w in words(t)})


def test_banded_distance_is_the_edit_distance_within_the_limit():
    rng = np.random.default_rng(1)
    texts, limits = [], []
    for _ in range(800):
        a = rng.integers(0, rng.integers(2, 9), rng.integers(0, 25))
        b = rng.integers(0, 9, rng.integers(0, 25)) if rng.random() < 0.4 else np.insert(np.delete(a, slice(1, 3)), 0, rng.integers(0, 9, 2))
        texts += [a, b]
        limits.append(int(rng.integers(0, 14)))
    left, limit = np.arange(0, len(texts), 2), np.array(limits)
    got = N.banded_in_turns(N.Texts(texts), left, left + 1, limit)
    assert got.tolist() == [min(distance(texts[k], texts[k + 1]), x + 1) for k, x in zip(left, limits, strict=True)]


def test_bags_never_overstate_the_distance():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = rng.integers(0, 30, rng.integers(1, 60)).astype(np.uint32)
        b = np.delete(np.insert(a, rng.integers(0, len(a), 4), 99), slice(3, 6)).astype(np.uint32)
        shared = [int(np.minimum(u, v).sum()) for u, v in zip(N.bags(a, 4096), N.bags(b, 4096), strict=True)]
        assert N.least_distance(max(len(a), len(b)), *shared) <= distance(a, b)


def test_samples_keep_the_order_and_count_occurrences():
    def sketch(*texts):
        return N.order_min_hash(*N.shingles(*hashed_words([t.encode() for t in texts])))

    blocks = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    same, turned, again = sketch(" ".join(blocks), " ".join(blocks[::-1]), " ".join(blocks))
    assert (same == again).all()
    assert 0 < (same == turned).sum() < N.SAMPLES  # turned around, only samples inside one block agree
    once, twice = sketch(blocks[0], f"{blocks[0]} {blocks[0]}")
    assert (once != twice).any()
    assert not sketch("", "").any()


def corpus():
    rng = random.Random(8)
    rows = awkward()
    for g in range(12):
        base = [f"t{g}w{rng.randrange(60)}" for _ in range(rng.choice([4, 9, 30, 120, 400]))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.03, 0.1, 0.18, 0.3]))):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [f"n{rng.randrange(99)}"], [w[k], "more"]])
            rows.append((len(rows) + 100, " ".join(w), "en", "s"))
    shared = " ".join(f"share{i}" for i in range(60))  # a passage that many texts share
    for _ in range(80):
        own = " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([5, 14, 16, 60, 200])))
        rows.append((len(rows) + 100, f"{shared} {own}", "en", "s"))
    return rows


def brute(rows, similarity=0.8):
    texts = [words(t) for _, t, *_ in rows]
    numbers = {}
    codes = [[numbers.setdefault(w, len(numbers)) for w in t] for t in texts]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = codes[i], codes[j]
            most = N.allowed(len(a), len(b), similarity)
            if root(i) != root(j) and (a == b or abs(len(a) - len(b)) <= most and max(len(a), len(b)) < 10_000 and distance(a, b) <= most):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("block", [N.BLOCK, 5])
def test_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = corpus()
    roots = brute(rows)
    got = N.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == len({(r.class_id, r.class_size) for r in got})
    # Nothing is together that all pairs keep apart.
    of = {}
    for n, (i, *_) in enumerate(rows):
        of.setdefault(i, set()).add(roots[n])
    members = {}
    for r in got:
        members.setdefault(r.class_id, []).append(r.doc_id)
    for ids in members.values():
        assert len(set.intersection(*(of[i] for i in ids))) >= 1
    # Similar texts that share 0.7 of their five-word shingles, or all words, are together.
    mine = {r.doc_id: r.class_id for r in got if r.doc_id is not None and r.doc_id > 99}
    shingles = {i: {tuple(words(t)[k : k + 5]) for k in range(max(1, len(words(t)) - 4))} for i, t, *_ in rows if i in mine}
    position = {i: n for n, (i, *_) in enumerate(rows)}
    near = [(i, j) for i in mine for j in mine if i < j and roots[position[i]] == roots[position[j]]]
    close = [(i, j) for i, j in near if len(shingles[i] & shingles[j]) >= 0.7 * len(shingles[i] | shingles[j])]
    assert len(close) > 20
    assert all(mine[i] == mine[j] for i, j in close)


def test_drop_keeps_one_whole_row_of_each_class(spark):
    rows = awkward()
    table = docs(spark, rows)
    got = N.drop_near_duplicates(table)
    assert got.columns == table.columns
    ids = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert (4, "same row") in ids and ids.count((4, "same row")) == 1
    # '', null, blanks and signs have no words and are one class.
    assert len(ids) == len({tuple(words(t)) for _, t, *_ in rows})


def test_empty_table(spark):
    assert N.near_duplicates(docs(spark, [])).count() == 0
    assert N.drop_near_duplicates(docs(spark, [])).count() == 0


def met(n_words, edits, pairs=300):
    """The share of pairs that agree in a sample, of texts of some words of which a number, evenly spread, is replaced."""
    rng = np.random.default_rng(n_words + edits)
    texts = []
    for k in range(pairs):
        base = [f"p{k}w{x}" for x in rng.integers(0, 10**9, n_words)]
        other = list(base)
        for e in range(edits):
            other[int((e + 0.5) * n_words / edits)] = f"n{e}"
        texts += [" ".join(base).encode(), " ".join(other).encode()]
    sketch = N.order_min_hash(*N.shingles(*hashed_words(texts)))
    return (sketch[::2] == sketch[1::2]).any(1).mean()


# The figures of near_duplicates() and the README, give or take a tenth.
@pytest.mark.parametrize(
    "words_, edits, least, most",
    [(10, 1, 0, 0), (12, 1, 0.01, 0.21), (20, 1, 0.85, 1), (20, 2, 0.12, 0.32), (20, 4, 0, 0.1), (200, 10, 0.88, 1), (200, 20, 0.53, 0.73), (200, 30, 0, 0.18), (200, 40, 0, 0.1)],
)
def test_recall_by_edit_similarity_is_as_stated(words_, edits, least, most):
    assert least <= met(words_, edits) <= most

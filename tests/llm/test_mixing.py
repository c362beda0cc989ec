import math
import re
from fractions import Fraction

import pytest

from vitrine.llm import mixing

from .helpers import awkward, docs, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by sharing the excess again until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = sum(weight[s] for s in order if s not in stopped)
        target = {s: Fraction(3 * sizes[s]) if s in stopped else Fraction(weight[s] * left, share) for s in order}
        above = {s for s in order if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def check(rows, plan):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    target = water(sizes)
    taken = {}
    for r in plan:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(target[r.source]))
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert n == math.floor(target[s] + Fraction(1, 10**6))


def test_targets_and_budgets(spark):
    rows = awkward() + [(1000 + i, "word " * (i % 13), "en", f"s{i % 7}") for i in range(400)] + [(5000 + i, "w w", "en", "hot") for i in range(300)]
    plan = mixing.mix_plan(docs(spark, rows)).collect()
    assert len(plan) == len(rows)
    check(rows, plan)


def test_reruns_and_partitions_agree(spark):
    rows = [(i, "word " * (i % 9), "en", f"s{i % 3}") for i in range(200)]
    one = mixing.mix_plan(docs(spark, rows)).select("doc_id", "taken")
    other = mixing.mix_plan(docs(spark, rows[::-1]).repartition(7)).select("doc_id", "taken")
    assert plain(one) == plain(other)


def test_mix_takes_what_the_plan_says(spark):
    rows = awkward() + [(1000 + i, f"a{i} b  c\td", "en", "s") for i in range(40)]
    table = docs(spark, rows)
    mixed = mixing.mix_sources(table)
    assert mixed.columns == table.columns
    words, want = {}, {}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text))
    for r in mixing.mix_plan(table).collect():
        want[r.source] = want.get(r.source, 0) + r.taken
    assert words == {s: n for s, n in want.items() if n}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (2, "", "en", "s")]])
def test_nothing_to_mix(spark, rows):
    assert [(r.taken, r.target) for r in mixing.mix_plan(docs(spark, rows)).collect()] == [(0, 0.0)] * len(rows)
    assert mixing.mix_sources(docs(spark, rows)).count() == 0

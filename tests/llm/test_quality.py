import math
import re
from collections import Counter

import numpy as np
import pytest

from vitrine.llm import quality as Q

from .helpers import awkward, docs, plain

TOKEN = re.compile(r"[0-9a-z\x80-\U0010FFFF]+|[^0-9a-z\x80-\U0010FFFF\x20\x09-\x0D]+")


def labelled(spark, rows):
    return spark.createDataFrame([(r[0], r[1], 0) for r in rows], "doc_id long, quality int, text int")


def corpus():
    good = [(100 + i, " ".join(f"plain words {n} follow each other here" for n in range(12)) + f" and end with {i}", "en", "s") for i in range(60)]
    junk = [(200 + i, f"buy*** now$$$ item{i}%%% deal### " * 3, "en", "s") for i in range(15)]
    labels = [(100 + i, 1) for i in range(0, 60, 2)] + [(200 + i, 0) for i in range(0, 15, 2)]
    return good + junk + awkward(), labels + [(None, 1), (3, None)]


def test_grams_are_tokens_and_pairs():
    texts = ["a b, b b", "", "x", "!!"]
    _, first = Q.grams([t.encode() for t in texts])
    tokens = [TOKEN.findall(t) for t in texts]
    assert list(np.diff(first)) == [len(t) + max(0, len(t) - 1) for t in tokens]
    one, at = Q.grams([b"q q", b"zz zz"])
    assert one[at[0] + 2] == one[at[1] + 2]  # repetition, whatever is repeated


def test_weights_against_plain_counts(spark):
    rows, labels = corpus()
    table, buckets = docs(spark, rows), 512
    got = {r.doc_id: r.log_weight for r in Q.resample(table, labelled(spark, labels), buckets=buckets).where("doc_id IS NOT NULL").collect() if r.doc_id != 4}

    def found(text):
        return Counter(Q.grams([(text or "").encode()], buckets)[0].tolist())

    raw, target = Counter(), Counter()
    good = {i for i, q in labels if q == 1}
    for i, t, *_ in rows:
        raw += found(t)
        if i in good and i is not None:
            target += found(t)
    n, m = sum(raw.values()), sum(target.values())
    for i, t, *_ in rows:
        if i in got:
            want = sum(k * math.log((target[b] + 1) / (m + buckets) / ((raw[b] + 1) / (n + buckets))) for b, k in found(t).items())
            assert got[i] == pytest.approx(want)


def test_sample_size_and_junk(spark):
    rows, labels = corpus()
    table = docs(spark, rows)
    got = Q.resample(table, labelled(spark, labels)).collect()
    share = sum(q == 1 for _, q in labels) / sum(q is not None for _, q in labels)
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    cutoff = keys[round(share * len(rows)) - 1]
    assert all(r.kept == (r.gumbel_key >= cutoff) for r in got)
    assert not any(r.kept for r in got if (r.doc_id or 0) >= 200)
    assert all(r.kept for r in got if 100 <= (r.doc_id or 0) < 200)
    kept = Q.drop_rejected(table, labelled(spark, labels))
    assert kept.columns == table.columns
    assert kept.count() == sum(r.kept for r in got)


def test_without_labels_all_stay(spark):
    rows = awkward()
    assert plain(Q.drop_rejected(docs(spark, rows), labelled(spark, []))) == plain(docs(spark, rows))
    assert Q.resample(docs(spark, []), labelled(spark, [(1, 1)])).count() == 0
    assert Q.drop_rejected(docs(spark, []), labelled(spark, [(1, 0)])).count() == 0

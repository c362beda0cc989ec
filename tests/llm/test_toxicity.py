import random

import pytest
from pyspark.sql import functions as F

from vitrine.llm import toxicity as T

from .helpers import awkward, docs, part


def corpus():
    rng = random.Random(6)
    calm = [f"calm{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(calm, k=rng.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grumblix", "snarkoid", "snarkoids", "zorptard"]))
        rows.append((100 + i, " ".join(w), "en", "s"))
        labels.append((100 + i, int(toxic)))
    return rows + awkward(), labels + [(1, None), (None, 1)]


def labelled(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, toxic int, text int")


def test_held_out_rows(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in T.score_toxicity(docs(spark, rows), labelled(spark, labels), trees=6).where("doc_id > 99").collect()}
    truth = dict(labels)
    held = [i for i in got if part(i, 5) == 0]
    assert all(got[i].held_out == (part(i, 5) == 0) for i in got)
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus()
    turned = [(i, 1 - y if i is not None and y is not None and part(i, 5) == 0 else y) for i, y in labels]
    one, other = (
        {r.doc_id: r.score for r in T.score_toxicity(docs(spark, rows), labelled(spark, x), trees=3).where("doc_id > 9").collect()} for x in (labels, turned)
    )
    assert one == pytest.approx(other)


def test_calibrating_rows_do_not_teach_the_lexicon(spark, monkeypatch):
    rows, labels = corpus()
    taught, learn = [], T.learn_lexicon

    def spy(docs, labels, *rest):
        taught.append({r[0] for r in labels.select("_label_id").collect()})
        return learn(docs, labels, *rest)

    monkeypatch.setattr(T, "learn_lexicon", spy)
    got = T.score_toxicity(docs(spark, rows), labelled(spark, labels), trees=2)
    assert got.count() == len(rows)
    may = {i for i, y in labels if i is not None and y is not None and part(i, 5) != 0}
    ids = spark.createDataFrame([(i,) for i in may], "i long")
    calibrating = {r.i for r in ids.where(F.pmod(F.xxhash64("i", F.lit(T.SEED + 1)), F.lit(T.CALIBRATION_PART)) == 0).collect()}
    assert calibrating and taught == [may - calibrating]


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (3, 0)], 0.0)])
def test_without_both_labels(spark, labels, score):
    got = T.score_toxicity(docs(spark, awkward()), labelled(spark, labels)).collect()
    assert len(got) == len(awkward()) and {r.score for r in got} == {score}


def test_empty_table(spark):
    assert T.score_toxicity(docs(spark, []), labelled(spark, [(1, 1), (2, 0), (3, 1), (4, 0)])).count() == 0


def test_features():
    found = dict(zip(T.FEATURES, T.Features({"grum": 2.0, "grumb": 3.0}).of("You are a GRUMBLIX, stupid! 1diot!! s**t aaah"), strict=True))
    assert (found["hits"], found["heaviest"], found["insults"], found["near_person"], found["nearest_person"]) == (1, 3.0, 1, 2, 3)
    assert found["disguised_hits"] == 1 and found["masked"] > 0 and found["long_runs"] > 0 and found["capitals"] > 0
    assert len(T.Features({}).of("")) == len(T.FEATURES)

import math
import random

import pytest

from vitrine.llm import language as G

from .helpers import awkward, docs, part

WORDS = {"xx": "lorem ipsum dolor amet elit".split(), "yy": "katze hund maus vogel fisch".split()}


def corpus():
    rng = random.Random(2)
    rows = [(100 + i, " ".join(rng.choices(WORDS[lang], k=12)), lang, "s") for i, lang in enumerate(["xx", "yy"] * 40)]
    return rows + [(i, t, None, s) for i, t, _, s in awkward()] + [(500, "loremipsum dolorem", None, "s"), (501, "hunde mäuse vögel", None, "s"), (502, "123 ² _", "xx", "s")]


def test_prediction_learns_only_its_part(spark):
    rows = corpus()
    got = {r.doc_id: r for r in G.identify(docs(spark, rows)).where("doc_id > 99").collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows if lang and i != 502)
    assert (got[500].lang_pred, got[501].lang_pred, got[502].lang_pred, got[502].score) == ("xx", "yy", "und", 0.0)
    assert all(got[i].held_out == (part(i, 3) == 1) for i in got)
    # Labels of the held-out part do not matter.
    turned = [(i, t, "zz" if i is not None and part(i, 3) == 1 else lang, s) for i, t, lang, s in rows]
    again = {r.doc_id: r for r in G.identify(docs(spark, turned)).where("doc_id > 99").collect()}
    assert again == got


def test_rows_and_undetermined(spark):
    rows = corpus()
    got = G.identify(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {2, 3, 7, 9, 502}
    assert all(0 <= r.score <= 1 and (r.held_out is not None) for r in got)
    assert G.identify(docs(spark, [])).count() == 0
    assert {r.lang_pred for r in G.identify(docs(spark, awkward()[2:5])).collect()} == {"und"}


def test_words_before_ever_shorter_grams():
    model = G.Model(["a", "b"], {"known": {"a": 3, "b": 1}}, {"^xy": {"a": 5}, "x": {"b": 2}, "y": {"a": 1, "b": 1}})
    assert model.score("known") == pytest.approx([0.0, 0.0])  # the only word of either language
    assert model.score("xyz") == pytest.approx(list(model.grams["^xy"]))
    assert model.score("zx") == pytest.approx(list(model.grams["x"]))
    assert not model.score("q").any()
    two = G.Model(["a", "b"], {"u": {"a": 3, "b": 1}, "v": {"a": 1, "b": 3}}, {})
    assert two.score("u") == pytest.approx([math.log(3.5 / 5), math.log(1.5 / 5)])


def test_accuracy_on_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = G.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)

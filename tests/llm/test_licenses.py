import random

from vitrine.llm import licenses as L

from .helpers import LONG, awkward, docs, words


def test_automaton_against_brute_force():
    automaton = L.Automaton(L.PHRASES, L.TEMPLATES)
    texts = [words(t) for ts in L.TEMPLATES.values() for t in ts] + [words(p) for p in L.PHRASES]
    known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    vocabulary, rng = sorted({w for t in texts for w in t}), random.Random(3)
    for _ in range(300):
        tokens = []
        while len(tokens) < 50:
            t = rng.choice(texts)
            i = rng.randrange(len(t))
            tokens += rng.choice([["zzz"], [rng.choice(vocabulary)], t[i : i + rng.randint(1, 12)]])
        places, matches = automaton.scan([t.encode() for t in tokens])
        assert sorted(places) == sorted(
            (i, p) for p, phrase in enumerate(L.PHRASES) for i in range(len(tokens)) if tokens[i : i + len(words(phrase))] == words(phrase)
        )
        statistics = []
        for i in range(len(tokens)):
            size = 0
            while size <= i and tuple(tokens[i - size : i + 1]) in known:
                size += 1
            statistics.append(size)
        statistics.append(0)
        ends = [(i - s + 1, s) for i, s in enumerate(statistics[:-1]) if s >= L.LONG and statistics[i + 1] != s + 1]
        assert sorted(m[:2] for m in matches) == ends


def test_spans_and_labels(spark):
    mit = L.TEMPLATES["mit"][1]
    broken = mit.replace("obtaining a copy", "who obtains one copy")
    rows = awkward() + [
        (20, f"Code. {mit} More.", "en", "s"), (21, broken.upper(), "en", "s"), (22, " ".join(mit.split()[:9]), "en", "s"),
        (23, "ALL rights -- reserved; licensed under CC BY-SA 4.0, cc by. All rights reserved", "en", "s"), (24, LONG + " general public license", "en", "s"),
    ]
    got = {r.doc_id: r for r in L.scan_licenses(docs(spark, rows)).where("doc_id > 19 OR doc_id = 3").collect()}
    assert got[20].labels == got[21].labels == "mit" and got[20].base_labels == ""
    assert (got[20].spans[0].first_word, got[20].spans[0].last_word, got[20].score) == (1, len(words(mit)), 1.0)
    assert L.COVERED <= got[21].score < 1
    assert (got[22].labels, got[22].score, got[22].n_base, got[22].first_word) == ("", 0.0, 0, None)
    assert (got[23].n_base, got[23].first_word, got[23].last_word) == (4, 0, 12)
    assert got[23].base_labels == "cc-by,reserved" and got[23].labels == "cc-by,cc-by-sa,reserved"
    assert (got[24].n_base, got[24].first_word, got[24].labels) == (1, len(words(LONG)), "gpl")
    assert (got[3].n_words, got[3].score) == (0, 0.0)


def test_every_row_and_empty_table(spark):
    rows = awkward()
    got = L.scan_licenses(docs(spark, rows))
    assert sorted(r.n_words for r in got.collect()) == sorted(len(words(t)) for _, t, *_ in rows)
    assert L.scan_licenses(docs(spark, [])).count() == 0

import random

from vitrine.llm import decontaminate as D

from .helpers import awkward, docs, plain, words


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if item is None else str(item))
    out = []
    for i, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def case():
    rng = random.Random(4)
    items = [(n, " ".join(rng.choices("abcdefgh", k=rng.randint(3, 40)))) for n in range(12)]
    items += [(77, "Short ITEM"), (77, "short item"), (None, "other one"), (5, None), (6, "")]
    rows = awkward()
    for n in range(60):
        parts = []
        for _ in range(4):
            t = rng.choice(items)[1] or ""
            w = t.split()
            a = rng.randrange(len(w) + 1)
            parts += [" - ".join(w[a : a + rng.randint(5, 20)]).upper(), " ".join(rng.choices("abcxyz", k=6))]
        rows.append((2000 + n, ", ".join(parts), "en", "s"))
    return rows, items


def test_against_brute_force(spark):
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for limit in (D.AUTOMATON_BYTES, 60):  # one automaton, and many that pass in turn
        got = D.scan(docs(spark, rows), benchmark, automaton_bytes=limit).select("doc_id", "n_words", "n_hit", "items")
        assert plain(got) == brute(rows, items)


def test_spans_are_places_in_the_original(spark):
    text = "Before — THE quick,\tBrown fox; jumps over the lazy dog (again) after"
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again")], "item_id long, text string")
    r = D.scan(docs(spark, [(1, text, "en", "s")]), bench).first()
    (span,) = r.spans
    assert text[span.start : span.end] == "THE quick,\tBrown fox; jumps over the lazy dog (again"
    # The dash is beyond ASCII and so a word of its own.
    assert (span.first_word, span.last_word, r.n_hit) == (2, 11, 10)


def test_drop_keeps_clean_rows_whole(spark):
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = docs(spark, rows)
    clean = {r[0] for r in brute(rows, items) if not r[2]}
    got = D.drop_contaminated(table, benchmark, automaton_bytes=60)
    assert got.columns == table.columns
    assert plain(got) == [r for r in plain(table) if r[0] in clean]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert plain(D.scan(docs(spark, []), none)) == []
    assert {r.n_hit for r in D.scan(docs(spark, awkward()), none).collect()} == {0}

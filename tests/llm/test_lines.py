import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from vitrine.llm import lines as L

from .helpers import awkward, docs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def run(spark, rows):
    return {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in L.dedup_lines(docs(spark, rows)).collect()}


def test_query_is_registered():
    assert "op5_line_dedup" in entry.queries()


def test_one_occurrence_of_equal_lines_stays(spark):
    rows = [
        (3, "Read more\nown three", "en", "a"), (1, "first\n\nREAD, more!\n\nfirst", "en", "a"), (2, "read  more", "en", "b"),
        (None, "own three\nlost", "en", "b"), (4, "-----\n***", "en", "a"), (5, "***\nmore read\r\n", "en", "a"),
    ]
    assert run(spark, rows) == {
        1: (5, 1, "first\n\nREAD, more!\n"), 2: (1, 1, ""), 3: (2, 1, "own three"), None: (2, 1, "lost"), 4: (2, 0, "-----\n***"), 5: (3, 1, "more read\r\n"),
    }


def test_near_equal_lines_are_connected_and_others_stay(spark):
    rng = random.Random(3)
    base = [f"word{rng.randrange(10**6)}" for _ in range(300)]

    def with_edit(*places):
        return " ".join(f"other{k}" if k in places else w for k, w in enumerate(base))

    # Each differs from the next in one word; and a line with the same words in another order.
    chain = [with_edit(*range(n)) for n in range(4)]
    turned = " ".join(base[150:] + base[:150])
    rows = [(n, t, "en", "a") for n, t in enumerate([*chain, turned], 10)]
    got = run(spark, rows)
    assert {i for i, (_, gone, _) in got.items() if gone == 0} == {10, 14}


def test_a_hot_bucket_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(L, "SALTED", 4)
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
    # Same words, so one SimHash: turned by n words, a line is near-equal to its likes only.
    texts = [" ".join(words[n:] + words[:n]) + " " + x for n in range(0, 40, 10) for x in ("a", "b", "c", "a b", "a c")]
    rng.shuffle(texts)
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(texts)):
        for j in range(i):
            if distance(texts[i], texts[j]) <= int(max(len(texts[i]), len(texts[j])) * 0.1):
                parent[root(i)] = min(root(i), root(j)) if root(j) != root(i) else root(i)
    roots = {root(i) for i in range(len(texts))}
    monkeypatch.setattr(L, "simhash", lambda piece: F.lit(0).cast("long"))
    got = run(spark, [(n, t, "en", "a") for n, t in enumerate(texts)])
    assert sum(gone == 0 for _, gone, _ in got.values()) == len(roots) == 4


def test_bits_by_majority(spark):
    def bits(text):
        words = [spark.sql(f"SELECT xxhash64('{w}') AS h").first().h for w in text.split()]
        return sum(1 << i for i in range(60) if 2 * sum(h >> i & 1 for h in words) > len(words))

    texts = ["a", "a b", "a b c", "a b c a", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", " ".join(["a"] * 16 + ["b"] * 15)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.simhash(F.col("t")).alias("bits")).collect()
    assert {r.t: r.bits for r in got} == {t: bits(t) for t in texts}


def test_pieces(spark):
    long = " ".join(f"word{n}" for n in range(60))
    rows = [("a",), ("a b c d",), ("ab cd ef gh ij kl",), (long,)]
    got = {r.t: r.p for r in spark.createDataFrame(rows, "t string").select("t", L.pieces(F.col("t")).alias("p")).collect()}
    assert got["a"] == ["a"] and got["a b c d"] == ["a b", "c d"]
    assert got["ab cd ef gh ij kl"] == ["ab cd ef", "gh ij kl"]
    assert len(got[long]) == L.SAMPLED and all(p in long and L.LEAST <= len(p) and len(p.split()) <= 31 for p in got[long])


def recall(spark, words, edits, pairs=200, seed=5):
    """The part of pairs of random lines, ``edits`` words of the second replaced by others of like length, that is found."""
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))

    rows = []
    for n in range(pairs):
        line = [word() for _ in range(words)]
        other = list(line)
        for k in rng.sample(range(words), edits):
            other[k] = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in other[k])
        if distance(" ".join(line), " ".join(other)) <= len(" ".join(line)) // 10:
            rows += [(2 * n, " ".join(line), "en", "a"), (2 * n + 1, " ".join(other), "en", "a")]
    assert len(rows) > pairs / 10
    found = 2 * sum(gone for _, gone, _ in run(spark, rows).values()) / len(rows)
    print(f"{edits} of {words} words replaced: {found:.3f} of {len(rows) // 2} pairs")
    return found


def test_recall_by_words_and_edits(spark):
    assert recall(spark, 4, 1, pairs=400) >= 0.9
    assert recall(spark, 10, 1) >= 0.9
    assert recall(spark, 20, 1) >= 0.97
    assert recall(spark, 40, 2) >= 0.97
    assert recall(spark, 60, 5) >= 0.9


def test_all_pairs_of_a_table(spark):
    """Removals of the given documents equal those by comparing all pairs of distinct lines."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = table.select(F.explode(F.split("text", "\n")).alias("line")).select(L.normal_line(F.col("line")).alias("norm")).where("norm IS NOT NULL")
    total, distinct = lines.count(), lines.distinct().select(F.monotonically_increasing_id().alias("k"), "norm", F.length("norm").alias("size"))
    distinct = spark.createDataFrame(distinct.collect(), distinct.schema).repartition(16)
    a, b = (distinct.selectExpr(f"k AS {x}", f"norm AS norm_{x}", f"size AS size_{x}") for x in "ab")
    most = L._most(F.col("size_a"), F.col("size_b"), L.SIMILARITY)
    close = a.join(F.broadcast(b), F.expr("a < b AND abs(size_a - size_b) <= floor(greatest(size_a, size_b) * 0.1 + 1e-9)"))
    links = close.where(F.call_function("levenshtein", "norm_a", "norm_b", most) >= 0).select("a", "b").collect()
    parent = {}

    def root(i):
        while i in parent:
            i = parent[i]
        return i

    for x, y in links:
        if root(x) != root(y):
            parent[root(x)] = root(y)
    want = total - distinct.count() + len(parent)
    got = L.dedup_lines(table).agg(F.sum("n_removed")).first()[0]
    near = len(parent)
    assert near > 5 and want - 0.1 * near <= got <= want


def grouped(norms):
    """The group of each line, by comparing all pairs."""
    parent = list(range(len(norms)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in enumerate(norms):
        for j, b in enumerate(norms[:i]):
            most = max(len(a), len(b)) // 10
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(norms))]


def edited(rng, line, edits, letters):
    """``line`` with edits spread evenly: a character replaced, taken away or put in."""
    out, n = [], len(line)
    places = {k * n // edits + rng.randrange(max(1, n // edits // 3)) for k in range(edits)}
    for k, x in enumerate(line):
        out.append(x if k not in places else rng.choice(["", x + rng.choice(letters), rng.choice(letters)]))
    return " ".join("".join(out).split())


def test_no_near_equal_line_is_missed(spark):
    """Edits in all pieces of a line, blanks that come and go, few letters, characters beyond 16 bits."""
    rng, norms = random.Random(8), []
    for letters, sizes in (("abcdefghijklmnopqrstuvwxyz", (10, 19, 20, 45, 90, 140)), ("ab", (9, 12, 30, 60)), ("a\U00020000b\u00e9", (11, 50, 120))):
        for size in sizes:
            for _ in range(4):
                line = "".join(rng.choice(letters + " ") for _ in range(size))
                line = " ".join(line.split()) or "a"
                norms += [line, *[edited(rng, line, max(1, len(line) // 10), letters) for _ in range(2)], edited(rng, line, 1 + len(line) // 8, letters)]
    norms = [n for n in dict.fromkeys(norms) if n]
    groups = grouped(norms)
    got = run(spark, [(n, t, "en", "a") for n, t in enumerate(norms)])
    want = {min(n for n, h in enumerate(groups) if h == g) for g in set(groups)}
    assert len(norms) - len(want) > 60
    assert {n for n, (_, gone, _) in got.items() if gone == 0} == want


def test_missed_links_are_those_of_all_pairs(spark):
    rng, letters = random.Random(9), "abcdefghijklmnopqrstuvwxyz   "
    norms = ["-" * n for n in (8, 9, 10, 20, 22)] + ["".join(rng.choice(letters) for _ in range(1000))]
    norms += [edited(rng, norms[-1], 80, letters), edited(rng, norms[-1], 120, letters)]
    for size in (9, 10, 30, 80, 200):
        line = "".join(rng.choice("xy") for _ in range(size))
        norms += [line, line[1:] + "z", line[:-1], "z" + line, line[size // 2:] + line[: size // 2], *[edited(rng, line, size // 10 + n, "xy") for n in range(1, 4) if size >= 30]]
    norms = list(dict.fromkeys(norms))
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string").withColumn("bag", L.letters(F.col("norm")))
    got = {frozenset(r) for r in L.missed_links(lines).select("a", "b").collect()}
    near = [
        frozenset((i, j)) for i, a in enumerate(norms) for j, b in enumerate(norms[:i])
        if abs(len(a) - len(b)) <= max(len(a), len(b)) // 10 and distance(a, b) <= max(len(a), len(b)) // 10
    ]
    assert len(near) > 20 and got == set(near)
    one_team = lines.withColumn("team", F.lit(1).cast("long"))
    assert L.missed_links(one_team).count() == 0


def test_one_segment_left_as_it_is_at_any_place(spark):
    """Each other segment of the longer line has an edit, before or behind the one left, which moves by an odd or even number of places."""
    rng, letters, norms = random.Random(11), "abcdefghijklmnopqrstuvwxyz", []
    for size in (10, 23, 50, 87, 130, 211):
        for left in range(size // 10 + 1):
            line = "".join(rng.choice(letters) for _ in range(size))
            for taken in (0, 1, 2):
                other, cuts = list(line), [k * size // (size // 10 + 1) for k in range(size // 10 + 2)]
                for k in range(size // 10 + 1):
                    place = rng.randrange(cuts[k], cuts[k + 1])
                    if k != left:
                        other[place] = "" if k in range(left - taken, left) else "#"
                norms.append((line, "".join(other)))
    rows = [(2 * n + m, 2 * n + m, x) for n, pair in enumerate(norms) for m, x in enumerate(pair)]
    lines = spark.createDataFrame(rows, "key long, team long, norm string").withColumn("bag", L.letters(F.col("norm")))
    got = {frozenset(r) for r in L.missed_links(lines).select("a", "b").collect()}
    assert all(distance(*pair) <= len(pair[0]) // 10 for pair in norms)
    assert all(frozenset((2 * n, 2 * n + 1)) in got for n in range(len(norms)))


def test_parts_of_the_join_are_the_whole(spark):
    """Windows and segments asked for by cells and hashes are those of the whole, each in one part."""
    rng = random.Random(13)
    norms = ["".join(rng.choice("abcdefghijklm ") for _ in range(size)) for size in (1, 2, 9, 10, 11, 23, 60, 61, 119, 120, 121, 300, 1000) for _ in range(3)]
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string")
    for rows in (L.windows, L.segments):
        whole = sorted(map(tuple, rows(lines, 0.9).collect()))
        for cells, hashes in ((2, 1), (4, 1), (4, 3), (1, 2)):
            parts = [tuple(r) for i in range(cells) for k in range(hashes) for r in rows(lines, 0.9, None, (cells, i), (hashes, k)).collect()]
            assert sorted(parts) == whole


def test_rounds_hold_like_parts_of_all_classes(monkeypatch):
    monkeypatch.setattr(L, "LEAST_ROUND", 1)
    for chars in ({3: 10**9}, {k: 1 + 10**6 * (k % 5) for k in range(40)}, {1: 1, 2: 10**6, 3: 1}, {}):
        dealt = {k: 0 for k in chars}
        for steps, n, i in L.rounds(chars):
            assert 0 <= i < n and sum(chars[s] for s in steps) / n <= sum(chars.values()) / L.ROUNDS + 1
            for s in steps:
                dealt[s] += 1 / n
        assert all(abs(x - 1) < 1e-9 for x in dealt.values())
        assert len(L.rounds(chars)) <= 2 * L.ROUNDS + len(chars)


def test_any_number_of_rounds_joins_every_window(spark, monkeypatch):
    """The rounds of a class are dealt by cell and hash; whatever their number, each pair of a segment and a window meets in one of them."""
    rng, norms = random.Random(15), []
    for _ in range(6):
        line = "".join(rng.choice("abcdefghijklm ") for _ in range(100))
        norms += [line, line[:45] + "#" + line[46:], "#" + line[1:-1] + "#"]
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string")
    lines = lines.withColumns({"bag": L.letters(F.col("norm")), "class": L._step(F.length("norm"), 0.9)}).cache()
    steps = [r[0] for r in lines.select("class").distinct().collect()]

    def met(n):
        found = {}
        for i in range(n):
            for r in L._seeds(lines, 0.9, steps, n, i).collect():
                found[r.a, r.b] = found.get((r.a, r.b), 0) + r._places
        return found

    whole = met(1)
    assert len(whole) >= 18 and sum(whole.values()) > 100
    for n in (2, 3, 4, 5, 6):
        assert met(n) == whole
    monkeypatch.setattr(L, "LEAST_ROUND", 1)
    for k in range(1, 60):
        rounds = [(n, i) for (step, *_), n, i in L.rounds({1: k, 2: 60 - k}) if step == 1]
        dealt = [tuple(L._part(n, i).items()) for n, i in rounds]
        cells, hashes = L._part(*rounds[0]).values()
        assert len({*dealt}) == len(rounds) == cells[0] * hashes[0]


def test_many_rounds_find_the_same_links_and_leave_no_shuffle_files(spark, monkeypatch):
    """The rows of the exact join are many times the lines; no more than a part of them may lie on the disks at a time."""
    rng, letters, norms = random.Random(14), "abcdefghijklmnopqrstuvwxyz ", []
    for size in (30, 80, 81, 82, 200, 210):
        line = "".join(rng.choice(letters) for _ in range(size))
        norms += [line, *[edited(rng, line, size // 10 + n, letters) for n in (0, 0, 1, 3)]]
    norms = [n for n in dict.fromkeys(norms) if n]
    near = [{i, j} for i, a in enumerate(norms) for j, b in enumerate(norms[:i]) if distance(a, b) <= max(len(a), len(b)) // 10]
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string")
    monkeypatch.setattr(L, "LEAST_ROUND", 100)
    steps = {r[0]: r[1] for r in lines.groupBy(L._step(F.length("norm"), 0.9)).agg(F.sum(F.length("norm"))).collect()}
    assert len(L.rounds(steps)) > 5 and any(n > 4 for _, n, _ in L.rounds(steps))
    got = {frozenset(r) for r in L.missed_links(lines).select("a", "b").collect()}
    assert len(near) > 10 and got == {frozenset(x) for x in near}
    inside = []
    monkeypatch.setattr(L, "missed_links", lambda lines, similarity, found=L.missed_links: inside.append(spark.conf.get(L.CLEANUP)) or found(lines, similarity))
    before = spark.conf.get(L.CLEANUP)
    assert len(run(spark, [(n, t, "en", "a") for n, t in enumerate(norms)])) == len(norms)
    assert inside == ["true"] and spark.conf.get(L.CLEANUP) == before


def test_only_one_round_of_lines_and_pairs_is_stored(spark, monkeypatch):
    """Pairs grow faster than the lines: those of a round give way to those of the next, and many are compared in parts."""
    rng, letters, norms = random.Random(16), "abcdefghijklmnopqrstuvwxyz ", []
    for size in (60, 150):
        line = "".join(rng.choice(letters) for _ in range(size))
        norms += [line, *[edited(rng, line, size // 10 + n, letters) for n in (-3, -2, -1, 0, 0, 2)]]
    norms = [n for n in dict.fromkeys(norms) if n]
    near = {frozenset((i, j)) for i, a in enumerate(norms) for j, b in enumerate(norms[:i]) if distance(a, b) <= max(len(a), len(b)) // 10}
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string")
    paths, pairs, compared = {}, [], []

    def seen(f, to):
        def counted(*a):
            to.append((df := f(*a)).count())
            return df
        return counted

    monkeypatch.setattr(L, "LEAST_ROUND", 400)
    monkeypatch.setattr(L, "LEAST_PAIRED", 1, raising=False)
    monkeypatch.setattr(L, "MET", 1 / 1000, raising=False)
    monkeypatch.setattr(L, "SPLITS", 1, raising=False)
    monkeypatch.setattr(L, "work_dir", lambda spark, purpose, f=L.work_dir: paths.setdefault(purpose, f(spark, purpose)))
    monkeypatch.setattr(L, "_seeds", seen(L._seeds, pairs))
    monkeypatch.setattr(L, "_similar", seen(L._similar, compared))
    assert {frozenset(r) for r in L.missed_links(lines).select("a", "b").collect()} == near and len(near) > 5
    assert len([n for n in pairs if n]) > 2 and spark.read.parquet(paths["line-seeds"]).count() == pairs[-1] < sum(pairs)
    assert 0 < spark.read.parquet(paths["line-classes"]).count() < len(norms)
    assert len(compared) > len([n for n in pairs if n])
    steps = {r[0]: r[1] for r in lines.groupBy(L._step(F.length("norm"), 0.9)).agg(F.sum(F.length("norm"))).collect()}
    assert len(pairs) > len(L.rounds(steps))
    parts = lambda n, i: {(c, h) for c in range(4) for h in range(24) if L._part(n, i) == {"cells": (k := L._part(n, i)["cells"][0], c * k // 4), "hashes": (m := n // k, h % m)}}
    for n in (1, 2, 4, 8, 12):
        for i in range(n):
            assert parts(n, i) == set().union(*[parts(*x) for x in L._split(n, i)])
            assert sum(len(parts(*x)) for x in L._split(n, i)) == len(parts(n, i)) > 0


def test_less_than_a_joined_row_for_each_character(spark):
    rng = random.Random(12)
    norms = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)) for size in (60, 150, 240, 900) for _ in range(5)]
    lines = spark.createDataFrame([(k, k, n) for k, n in enumerate(norms)], "key long, team long, norm string")
    joined = L.windows(lines, 0.9).count() + L.segments(lines, 0.9).count()
    assert joined < sum(map(len, norms))


def test_repeated_rows_keep_their_lines_once(spark):
    rows = [(1, "one line\n\ntwo lines", "en", "a")] * 3 + [(None, "only here", "en", "b")] * 2 + [(1, None, "en", "c")] * 2
    got = sorted(tuple(r) for r in L.dedup_lines(docs(spark, rows)).where("doc_id = 1 AND text IS NOT NULL").collect())
    assert got == [(1, 3, 0, "one line\n\ntwo lines"), (1, 3, 2, ""), (1, 3, 2, "")]
    rest = sorted((tuple(r) for r in L.dedup_lines(docs(spark, rows)).where("doc_id IS NULL OR text IS NULL").collect()), key=repr)
    assert rest == sorted([(None, 1, 0, "only here"), (None, 1, 1, ""), (1, 0, 0, None), (1, 0, 0, None)], key=repr)


def test_awkward_rows(spark):
    rows = awkward()
    got = L.dedup_lines(docs(spark, rows))
    assert got.columns == ["doc_id", "n_lines", "n_removed", "text"]
    out = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert len(out) == len(rows)
    assert out.count((4, "same row")) == 1 and out.count((4, "")) == 1 and (5, "") in out
    assert (3, None) in out and (2, "") in out and (7, " \t\n") in out
    assert L.dedup_lines(docs(spark, [])).count() == 0

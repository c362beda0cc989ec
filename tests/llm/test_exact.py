import hashlib

import pytest

from vitrine.llm import exact

from .helpers import awkward, docs, plain


def brute(rows):
    groups = {}
    for n, (i, t, *_) in enumerate(rows):
        norm = "".join(c for c in t or "" if c not in exact.BLANKS)
        groups.setdefault(norm, []).append((-len(t or ""), i is None, i or 0, n))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            out.append((None if m[1] else m[2], None if best[1] else best[2], len(members), m == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy", [exact.HEAVY, 1])
def test_groups(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact, "HEAVY", heavy)  # with one heavy digest, most groups go through the shuffle
    rows = awkward() + [(100 + i, "copy  of\na" + " " * (i % 5), "en", "s") for i in range(300)]
    assert plain(exact.exact_duplicates(docs(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert plain(exact.exact_duplicates(docs(spark, []))) == []


def test_blanks_only_are_ascii(spark):
    rows = [(1, "a b", "en", "s"), (2, "a b", "en", "s"), (3, "a\x0bb\r", "en", "s")]
    got = {r.doc_id: r.group_size for r in exact.exact_duplicates(docs(spark, rows)).collect()}
    assert got == {1: 2, 2: 1, 3: 2}

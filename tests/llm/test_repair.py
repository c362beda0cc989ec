"""Conversation repair beside a search over all edits, and the survivors' bounded memory."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from vitrine.llm import repair
from vitrine.llm.queries import QUERIES, table

LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, _number int, edits string, cost string"


def flagged(rows):
    """(role, text, blank, duplicate, truncated) in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACE)
        blank = not bare
        duplicate = not blank and (role, text) in seen
        out.append((role, text, blank, duplicate, not blank and not duplicate and bare[-1] not in ".!?"))
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every way: two inserts at most before each row and at the end."""
    ways = {("", ""): (0, ())}  # (audit, role initials) -> cost, lines

    def offer(table, key, cost, lines):
        if key not in table or table[key][0] > cost:
            table[key] = (cost, lines)

    def with_inserts(table):
        for _ in range(2):
            for (audit, roles), (cost, lines) in list(table.items()):
                nxt = "assistant" if roles.endswith("u") else "user"
                offer(table, (audit + "I", roles + nxt[0]), cost + 2, (*lines, nxt + ":"))
        return table

    for role, text, blank, duplicate, truncated in flagged(rows):
        fresh = {}
        for (audit, roles), (cost, lines) in with_inserts(ways).items():
            offer(fresh, (audit + "D", roles), cost + 3, lines)
            if blank or duplicate:
                continue
            for edit, spoken, extra in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                if spoken[:1] and LEGAL.fullmatch(roles + spoken[:1] + {"s": "ua", "u": "a"}.get(spoken[:1], "")):
                    offer(fresh, (audit + edit, roles + spoken[0]), cost + extra + truncated, (*lines, f"{spoken}:{text}"))
        least = min(c for c, _ in fresh.values())
        ways = {k: v for k, v in fresh.items() if v[0] <= least + 6}
    done = [(cost, audit, "\n".join(lines)) for (audit, roles), (cost, lines) in with_inserts(ways).items() if LEGAL.fullmatch(roles)]
    return min(done)


def expected(rows):
    """The contract of a damaged conversation; rows are (turn, role, text) in order."""
    flags = flagged([(r, t) for _, r, t in rows])
    cost, audit, repaired = cheapest([(r, t) for _, r, t in rows])
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, sum(f[2] for f in flags), sum(f[3] for f in flags),
        sum(f[4] for f in flags), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, repaired,
    )


def by_plain_code(rows):
    """What ``repair`` returns for a table of (conv_id, turn, role, text) without nulls in role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:16], hashlib.md5(r[2].encode()).hexdigest())
    return {c: expected(sorted(r, key=key)) for c, r in convs.items()}


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def repaired(spark, rows):
    return got(repair.repair(spark.createDataFrame([(*r, 1, "e", "c") for r in rows], SCHEMA)))


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Fine.", "Well?", "cut", "cut too", "  ", "", "Yes!", "No. ", "ok\n"]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, longest + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " "])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, rng.choice(texts) if rng.random() < 0.5 else f"Number {rng.randrange(99)}."))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_search_over_all_edits(spark, seed):
    rows = random_rows(seed, 120, 7)
    assert repaired(spark, rows) == by_plain_code(rows)


def test_every_short_role_sequence():
    """All sequences of up to five rows, straight through the survivors."""
    for n in range(1, 6):
        for roles in itertools.product(["user", "assistant", "system", "x"], repeat=n):
            rows = [(role, f"Text {i}." if i % 2 else f"Text {i}") for i, role in enumerate(roles)]
            s, found = repair.Survivors(), []
            for i in reversed(range(n)):
                found += s.add(i, repair._moves(roles[i][0], False, i % 2 == 0))
            found += s.finish()
            assert [f[0] for f in found] == list(range(n))[::-1]
            cost, audit, _ = cheapest(rows)
            assert (sum(f[3] for f in found), "".join(f[1] for f in reversed(found))) == (cost, audit), roles


def test_memory_does_not_follow_the_length():
    moves = [repair._moves(i, False, False) for i in "ua"]
    s, out = repair.Survivors(), 0
    for i in range(20_000):
        out += sum(1 for _ in s.add(i, moves[(i + 1) % 2]))
    assert s.widest <= 8 and out >= 19_990
    rng = random.Random(5)
    s = repair.Survivors()
    for i in range(20_000):
        list(s.add(i, repair._moves(rng.choice("uasx"), rng.random() < 0.2, rng.random() < 0.3)))
    assert s.widest <= 200


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", None), (1, 1, "user", "Hello."), (1, 1, "user", "Hello."), (None, 5, "assistant", "Alone."),
        (None, None, "system", "Be kind."), (2, None, "user", ""), (3, 0, "user", "long. " * 100_000), (3, 9, "assistant", "word " * 100_000),
    ]
    full = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert repaired(spark, rows) == by_plain_code(full)
    assert repaired(spark, []) == {}


def damaged(rows):
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        fault = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def test_query_by_plain_code(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = by_plain_code(list(damaged(rows)))
    for conv in {r[0] for r in rows} - set(want):
        want[conv] = (0, 0, 0, 0, 0, 0, "", "")
    want = {c: (*v[:7], hashlib.sha256(v[7].encode()).hexdigest()) for c, v in want.items()}
    assert got(QUERIES["op12_structure_repair"](spark, sf)) == want

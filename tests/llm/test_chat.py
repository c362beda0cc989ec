"""Reply trees and the chat template."""

import hashlib

from pyspark.sql import functions as F
from vitrine.llm import chat
from vitrine.llm.queries import QUERIES, table

TREE = "tree string, node long, parent long, role string, text string, score double, path int, place int, key string, up long"
NASTY = ["", "\\", "\\s", "\\p|", "<|", "<\\p", "<<|im_end|>", "|im_end|>\n<|im_start|>", "a\nb\\nc", "\\\\n<|", "été 𝄞", None]


def trees(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", 3) for r in rows], TREE)


def plain_paths(rows, per_tree):
    """Every root-to-leaf path by walking up, best sums first."""
    known = {(t, n): (t, n, p, role, text, s) for t, n, p, role, text, s in rows}
    parents = {(t, p) for t, n, p, *_ in rows if (t, p) in known}
    found = {}
    for (t, n), row in known.items():
        if (t, n) in parents:
            continue
        path, seen = [row], {(t, n)}
        while (up := (t, path[-1][2])) in known and up not in seen:
            seen.add(up)
            path.append(known[up])
        if (t, path[-1][2]) not in seen:
            found.setdefault(t, []).append((-sum(r[5] or 0.0 for r in path), n, [r[1] for r in path]))
    return {(t, n): path for t, paths in found.items() for _, n, path in sorted(paths)[:per_tree]}


FOREST = [
    ("a", 1, None, "user", "hi", 1.0), ("a", 2, 1, "assistant", "yes", 5.0), ("a", 3, 1, "assistant", "no", 2.0),
    ("a", 4, 3, "user", "why", 3.0), ("a", 5, 3, "user", "how", None), ("a", 6, 4, "assistant", "so", 0.5),
    (None, 10, None, "user", None, 1.0), (None, 11, 10, None, "tie", 1.0), (None, 12, 10, "assistant", "tie", 1.0),
    ("b", 20, 99, "user", "its parent is missing", 1.0), ("b", 21, 1, "user", "its parent is elsewhere", 1.0),
    ("c", 30, 31, "user", "circle", 1.0), ("c", 31, 30, "user", "circle", 1.0), ("c", 32, 31, "user", "below a circle", 1.0),
] + [("long", 100 + i, 99 + i if i else None, "user", f"turn {i}", 0.1) for i in range(40)]


def test_paths_equal_walking_up(spark):
    for per_tree in (1, 2):
        rows = chat.reply_paths(trees(spark, FOREST), per_tree).collect()
        got = {}
        for r in sorted(rows, key=lambda r: r["place"]):
            got.setdefault((r["tree"], r["path"]), []).append(r["node"])
        assert got == plain_paths(FOREST, per_tree)


def test_formatted_trees_read_back(spark):
    back = chat.read_back(chat.format_trees(trees(spark, FOREST), 2)).collect()
    text = {r[1]: (r[3] or "", r[4] or "") for r in FOREST}
    paths = plain_paths(FOREST, 2)
    assert {(r["tree"], r["path"]) for r in back} == set(paths)
    for r in back:
        assert [tuple(t) for t in r["turns"]] == [text[n] for n in reversed(paths[r["tree"], r["path"]])]


def test_escapes_are_reversible(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for header in (False, True):
        e = chat.escape(F.col("t"), header)
        for r in df.select("t", e.alias("e"), chat.unescape(e, header).alias("u")).collect():
            assert r["u"] == r["t"] and (r["t"] is None or "<|" not in r["e"])
            assert not header or "\n" not in (r["e"] or "")


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, tree int, key string, node int")


def test_awkward_conversations(spark):
    rows = [(1, i, role, t) for i, (t, role) in enumerate(zip(NASTY, ["user", "assistant"] * 6))]
    rows += [(None, 0, "user", "a"), (None, None, None, "first"), (None, None, None, None), (2, 0, "user\n<|", "x"), (2, 1, "assistant", "long " * 200_000)]
    rows += [(3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "user", "tie")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(conversations(spark, rows))).collect()}
    assert set(got) == {1, None, 2, 3}
    for conv in (1, 2):
        want = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        assert [tuple(t) for t in got[conv]["turns"]] == want
        assert got[conv]["trained"] == "".join(t for role, t in want if role == "assistant")
    assert [tuple(t) for t in got[3]["turns"]] == [("assistant", "same"), ("assistant", "same"), ("user", "tie")]
    assert [t["text"] for t in got[None]["turns"]][2] == "a"
    assert sorted(t["text"] for t in got[None]["turns"][:2]) == ["", "first"]
    assert "".join(c["text"] for c in got[1]["chunks"]) == got[1]["formatted"]


def test_empty(spark):
    assert chat.format_conversations(conversations(spark, []).limit(0)).count() == 0
    assert chat.format_trees(trees(spark, []), 3).count() == 0


def test_query_by_plain_code(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["conv_id"]: r for r in QUERIES["op11_chat_format"](spark, sf).collect()}
    said = {-1: [(0, "user", chat.MINUS_ONE), (1, "assistant", chat.MINUS_ONE)]}
    for r in table(spark, sf, "conversations").collect():
        said.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    assert set(got) == set(said)
    for conv, turns in said.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_paths_stay_in_the_jvm(spark):
    plan = QUERIES["op11_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

Edits of a row: Keep (0), Rerole to user or assistant (2), Delete (3, required for blank rows and duplicates); Insert an
empty user or assistant turn anywhere (2). A truncated row that is not deleted adds 1. The repaired roles read
``(s?(ua)+)?`` by their initials. Of equally cheap edits the one whose letters, D I K R, sort first is taken.

Survivor-coalescence Viterbi, run from the last row to the first: each of the four states (start, after system, after
user, after assistant) keeps one survivor, the best way from there to the end, as a node that points to the next row's
node. Nodes count who points at them; what loses its last reference is freed. Once one node alone is left of the latest
pending row, all survivors share it and its edits are written out. Memory is thus what the survivors still disagree
about. Running backwards makes a tie between two survivors a comparison of whole texts to the end, which later rows only
prefix; the other way round an earlier winner can lose, because an inserted turn makes one text a prefix of another.

A conversation is one sequence: its slim rows (a number, an initial, two flags) pass through one task, in order, without
being collected. Texts meet the edits in one shuffle at the end; a repaired conversation is one row.

Defined cases: null role and text are one space, so such a row is blank or has an illegal role; rows are taken by turn,
null turns first, then by role, the text's first 16 characters and its digest; equal rows stay next to each other; null
ids are one conversation; an empty role has no initial and cannot be kept. An empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, stored, with_fields

SPACES = " \t\n\x0b\f\r"
ENDINGS = ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)
OUT_ROWS = 20_000


def _spoken(state: int) -> tuple[int, str]:
    """The state after the turn that ``state`` expects, and that turn's initial."""
    return (ASSISTANT, "a") if state == USER else (USER, "u")


def _moves(initial: str, delete: bool, truncated: bool) -> list[list[tuple[int, str, str, int]]]:
    """For each state before a row: (cost, edits, roles, state after it), at most the best one per state after it.

    ``roles`` names beside each edit the role it speaks: u or a, k for the row's own, d for none.
    """
    table = []
    for before in range(4):
        best: dict[int, tuple[int, str, str]] = {}
        state, edits, roles = before, "", ""
        for inserted in range(3):  # a third insert would lead back to a state that one reaches
            expected = _spoken(state)
            options = [(3, "D", "d", state)]
            if not delete:
                options.append((2 + truncated, "R", expected[1], expected[0]))
                if initial == expected[1] or initial == "s" and state == START and not inserted:
                    options.append((int(truncated), "K", "k", SYSTEM if initial == "s" else expected[0]))
            for cost, edit, role, after in options:
                move = (2 * inserted + cost, edits + edit, roles + role)
                best[after] = min(best.get(after, move), move)
            state, edits, roles = expected[0], edits + "I", roles + expected[1]
        table.append([(*move, after) for after, move in sorted(best.items())])
    return table


class Node:
    """Edits of one row on the way from a state to the end."""

    __slots__ = ("row", "edits", "roles", "cost", "total", "next", "refs")

    def __init__(self, row, edits, roles, cost, total, following):
        self.row, self.edits, self.roles, self.cost, self.total, self.next = row, edits, roles, cost, total, following
        self.refs = 0


def _sorts_first(a: Node, b: Node) -> bool:
    """Whether the whole text of a sorts before that of b; both start at the same row."""
    left, right = [], []
    while a is not b:
        left.append(a.edits)
        right.append(b.edits)
        a, b = a.next, b.next
    x, y = "".join(left), "".join(right)
    if not (x.startswith(y) or y.startswith(x)):
        return x < y
    # Both use up the same rows, so the longer text ends in inserts before what is shared. The shared text decides by
    # the first letter that is no insert, which its first row holds: a later letter sorts after I, so the inserts win.
    rest = next((c for c in (a.edits if a is not None else "") if c != "I"), "")
    return len(x) > len(y) if rest in ("K", "R") else len(x) < len(y)


class Survivors:
    """Rows of one conversation, fed from the last to the first; gives out edits as soon as they are certain."""

    def __init__(self) -> None:
        self.tail = ("", "", 0)
        ends = [("", "", 0), ("II", "ua", 4), ("I", "a", 2), ("", "", 0)]
        self.alive = [Node(None, e, r, c, c, None) for e, r, c in ends]
        for node in self.alive:
            node.refs = 1
        self.pending: deque[list[Node]] = deque([list(self.alive)])  # per row, the nodes still referred to
        self.widest = 0

    def add(self, row: int, moves: list[list[tuple[int, str, str, int]]]) -> Iterator[tuple[int, str, str, int]]:
        fresh = []
        for options in moves:
            best = None
            for cost, edits, roles, after in options:
                following = self.alive[after]
                total = cost + following.total
                if best is not None and total > best.total:
                    continue
                node = Node(row, edits, roles, cost, total, following)
                if best is None or total < best.total or _sorts_first(node, best):
                    best = node
            best.next.refs += 1
            best.refs = 1
            fresh.append(best)
        old, self.alive = self.alive, fresh
        self.pending.append(list(fresh))
        self._release(old)
        self.widest = max(self.widest, len(self.pending))
        yield from self._certain()

    def _release(self, nodes: list[Node]) -> None:
        freed = False
        for node in nodes:
            while node is not None:
                node.refs -= 1
                if node.refs:
                    break
                freed, node = True, node.next
        if freed:
            for place in range(len(self.pending) - 1, -1, -1):
                live = [n for n in self.pending[place] if n.refs]
                if len(live) == len(self.pending[place]) and place < len(self.pending) - 2:
                    break  # nothing was freed here, so nothing further on
                self.pending[place] = live

    def _certain(self) -> Iterator[tuple[int, str, str, int]]:
        while self.pending and len(self.pending[0]) == 1:
            node = self.pending[0][0]
            self.pending.popleft()
            if node.row is None:
                self.tail = (node.edits, node.roles, node.cost)
            else:
                yield node.row, node.edits + self.tail[0], node.roles + self.tail[1], node.cost + self.tail[2]
                self.tail = ("", "", 0)
            node.next = None

    def finish(self) -> Iterator[tuple[int, str, str, int]]:
        """The first row is in: the way from the start state is the answer."""
        others, self.alive = self.alive[1:], self.alive[:1]
        self._release(others)
        yield from self._certain()


def repair_edits(rows: DataFrame) -> DataFrame:
    """(conv_id, _number, edits, roles, cost) for rows (conv_id, _number, initial, must_delete, truncated)."""
    ordered = rows.select("conv_id", "_number", "initial", "must_delete", "truncated").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", F.desc("_number"))
    out = with_fields(rows.schema["conv_id"], "_number long, edits string, roles string, cost long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list] = {}
        held: tuple[list, ...] = ([], [], [], [], [])
        current, open_ = None, None
        kind = None

        def keep(conv, edits):
            for values in edits:
                for column, value in zip(held, (conv, *values)):
                    column.append(value)

        def batch():
            made = pa.RecordBatch.from_arrays(
                [pa.array(held[0], kind), pa.array(held[1], pa.int64()), pa.array(held[2], pa.string()), pa.array(held[3], pa.string()), pa.array(held[4], pa.int64())],
                names=["conv_id", "_number", "edits", "roles", "cost"],
            )
            for column in held:
                column.clear()
            return made

        for b in batches:
            kind = b.schema.field("conv_id").type
            for conv, number, *what in zip(*(b.column(i).to_pylist() for i in range(5))):
                if open_ is None or conv != current:
                    if open_ is not None:
                        keep(current, open_.finish())
                    current, open_ = conv, Survivors()
                what = tuple(what)
                if what not in known:
                    known[what] = _moves(*what)
                keep(conv, open_.add(number, known[what]))
                if len(held[0]) >= OUT_ROWS:
                    yield batch()
        if open_ is not None:
            keep(current, open_.finish())
            yield batch()

    return ordered.mapInArrow(run, out)


def faults(rows: DataFrame) -> DataFrame:
    """Slim rows (conv_id, _number, initial, blank, duplicate, truncated, illegal, new_turn, turn) of numbered rows.

    The first fault of a row counts. A row meets its predecessor by number and its first copy by the smallest number
    of an equal (role, text digest), so neither join has a hot key.
    """
    bare = F.rtrim("text", F.lit(SPACES))
    slim = rows.select(
        "conv_id", "turn", "_number", F.substring("role", 1, 1).alias("initial"), "role", "_digest",
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*ENDINGS)).alias("cut"),
    )
    first = slim.groupBy("conv_id", "role", "_digest").agg(F.min("_number").alias("_first")).select("_first")
    before = slim.select((F.col("_number") + 1).alias("_next"), F.col("conv_id").alias("_conv"), F.col("initial").alias("_initial"), F.col("turn").alias("_turn"))
    joined = slim.join(first, F.col("_number") == F.col("_first"), "left").join(
        before, (F.col("_number") == F.col("_next")) & F.col("conv_id").eqNullSafe(F.col("_conv")), "left"
    )
    duplicate = ~F.col("blank") & F.col("_first").isNull()
    legal = F.concat("_initial", "initial").isin("su", "ua", "au")
    return joined.select(
        "conv_id", "_number", "initial", "turn", "blank", duplicate.alias("duplicate"),
        (F.col("cut") & ~F.col("blank") & ~duplicate).alias("truncated"), (F.col("_next").isNotNull() & ~legal).alias("illegal"),
        (F.col("turn").isNotNull() & (F.col("_next").isNull() | ~F.col("_turn").eqNullSafe(F.col("turn")))).alias("new_turn"),
    )


def _lines() -> Column:
    """The repaired turns that the edits of a row give."""
    def turn(i: Column) -> Column:
        role = F.substring("roles", i, F.lit(1))
        spoken = F.when(role == "u", "user").when(role == "a", "assistant").otherwise(F.col("role"))
        text = F.when(F.substring("edits", i, F.lit(1)) == "I", "").otherwise(F.col("text"))
        return F.when(role != "d", F.concat(spoken, F.lit(":"), text))

    places = F.transform(F.sequence(F.lit(1), F.length("edits")), turn)
    return F.filter(places, lambda line: line.isNotNull())


def repair(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: what is wrong with it and its repaired text.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired). ``every`` (conv_id) adds
    conversations without rows; their counts are 0 and their texts empty.
    """
    clean = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    keyed = clean.withColumns({"_start": F.substring("text", 1, 16), "_digest": F.md5("text")})
    rows = numbered(keyed, ["conv_id", "turn", "role", "_start", "_digest"], "repair")
    flags = stored(faults(rows), "repair-faults")
    edits = repair_edits(flags.withColumn("must_delete", F.col("blank") | F.col("duplicate")))
    ids = (conversations if every is None else every).select("conv_id").distinct()
    parts = (
        flags.drop("initial").unionByName(edits, allowMissingColumns=True)
        .unionByName(rows.select("conv_id", "_number", "role", "text"), allowMissingColumns=True)
        .unionByName(ids, allowMissingColumns=True)
        .repartition("conv_id")  # serves both groupings
    )
    row = parts.groupBy("conv_id", "_number").agg(
        *[F.max(c).alias(c) for c in ("turn", "blank", "duplicate", "truncated", "illegal", "new_turn", "edits", "roles", "cost", "role", "text")]
    )
    count = lambda flag: F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0)).alias(flag)
    spoken = F.when(F.col("edits").isNotNull(), F.struct("_number", "edits", _lines().alias("lines")))
    whole = row.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.sum(F.col("new_turn").cast("long")), F.lit(0)).alias("gaps"),
        *[count(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.sort_array(F.collect_list(spoken)).alias("_all"),
    )
    return whole.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("_all.edits", "").alias("audit"), F.array_join(F.flatten("_all.lines"), "\n").alias("repaired"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that follow from id and turn: dropped, emptied, cut, repeated or re-roled rows."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), fault.alias("fault"))
    hurt = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), copies.alias("_copy")
    ).drop("_copy")

"""Chat formatting: reply trees become training conversations. DataFrame functions only.

Messages form trees by their parent. Ancestor tables for 1, 2, 4, ... steps come from joining each with itself, so a
tree of depth d takes about log2(d) joins. A walk over these tables adds up the scores from every leaf to its root, the
best leaves of each tree are chosen, and a second walk lists the messages of the chosen paths only. All of this moves
identifiers; texts are shuffled once, when a path is put together.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. In texts and roles a backslash becomes ``\\s`` and ``<|``
becomes ``<\\p``; in roles a line feed becomes ``\\n``. Escaped strings thus hold no control string, every backslash in
them starts a code, and replacing the codes, the backslash last, gives the original back.

A conversation table is a forest of chains: a row replies to the row before it (``linked``).

Defined cases: null texts and roles are empty; rows are taken by turn, null turns first, then by role, the text's
first 16 characters and its hash; equal rows stay, each a turn of its own; null ids are one conversation; a message whose parent is missing or belongs to
another tree is a root; messages in a circle of replies reach no root and are in no path. Empty tables give no rows.
Other columns are ignored, whatever their names. A formatted path is one row, so one path has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import numbered, stored

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
MINUS_ONE = "<|im_end|><|im_start|>assistant ok"


def escape(text: Column, header: bool = False) -> Column:
    safe = F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))
    return F.replace(safe, F.lit("\n"), F.lit("\\n")) if header else safe


def unescape(text: Column, header: bool = False) -> Column:
    if header:
        text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def linked(conversations: DataFrame) -> DataFrame:
    """(tree, node, parent, key, score) of a conversation table: every row replies to the one before it.

    ``key`` finds the row's text again: turn, role and text hash. Nodes are numbered over ranges of all rows and a
    row meets its predecessor by number, so a long conversation is no hot key. Every turn counts 1.
    """
    slim = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.substring(F.coalesce("text", F.lit("")), 1, 16).alias("start"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
    )
    rows = numbered(slim, ["tree", "turn", "role", "start", "hash"], "chat", "node")
    before = rows.select((F.col("node") + 1).alias("_node"), F.col("tree").alias("_tree"), F.col("node").alias("parent"))
    chained = rows.join(before, (F.col("node") == F.col("_node")) & F.col("tree").eqNullSafe(F.col("_tree")), "left")
    return chained.select("tree", "node", "parent", F.struct("turn", "role", "hash").alias("key"), F.lit(1.0).alias("score"))


def ancestors(messages: DataFrame) -> list[DataFrame]:
    """Tables (node, up, gained) for 1, 2, 4, ... steps: the ancestor and the score from the node up to it, exclusive.

    Rows whose ancestor does not exist are absent, so the tables shrink. Children of one parent share a join key;
    only left rows pile up there, which adaptive execution splits. A circle never ends: the loop stops once the
    steps exceed the number of rows.
    """
    parents = messages.select(F.col("node").alias("_node"), F.col("tree").alias("_tree"))
    own = messages.where("parent IS NOT NULL").join(
        parents, (F.col("parent") == F.col("_node")) & F.col("tree").eqNullSafe(F.col("_tree"))
    )
    step = stored(own.select("node", F.col("parent").alias("up"), F.col("score").alias("gained")), "chat-up")
    levels, rows = [], step.count()
    limit = rows
    while rows and 2 ** len(levels) <= limit:
        levels.append(step)
        far = step.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("gained").alias("_gained"))
        joined = step.join(far, F.col("up") == F.col("_node"))
        step = stored(joined.select("node", F.col("_up").alias("up"), (F.col("gained") + F.col("_gained")).alias("gained")), "chat-up")
        rows = step.count()
    return levels


def reply_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, path, rank, branch_score, place, node) of the best ``per_tree`` root-to-leaf paths of each tree.

    ``messages`` has tree, node (unique), parent and score. A path is named by its leaf and scored by the sum of its
    messages' scores, null scores counting 0; ties go to the smaller leaf. ``place`` counts from the leaf.
    """
    scored = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    levels = ancestors(scored)
    replied = scored.where("parent IS NOT NULL").select(F.col("parent").alias("_node"), F.col("tree").alias("_tree")).distinct()
    is_parent = (F.col("node") == F.col("_node")) & F.col("tree").eqNullSafe(F.col("_tree"))
    walk = scored.join(replied, is_parent, "left_anti").select("tree", F.col("node").alias("path"), F.col("node").alias("at"), F.lit(0.0).alias("total"))
    for level in reversed(levels):
        up = level.select(F.col("node").alias("at"), "up", "gained")
        walk = walk.join(up, "at", "left").select(
            "tree", "path", F.coalesce("up", "at").alias("at"), (F.col("total") + F.coalesce("gained", F.lit(0.0))).alias("total")
        )
    # What is left is the root; a leaf below a circle ends at a message that still has a parent.
    roots = scored.select(F.col("node").alias("at"), F.col("score").alias("_own"))
    looped = levels[0].select(F.col("node").alias("at")) if levels else scored.where("false").select(F.col("node").alias("at"))
    ended = walk.join(looped, "at", "left_anti").join(roots, "at")
    best = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "path")
    chosen = (
        ended.select("tree", "path", (F.col("total") + F.col("_own")).alias("branch_score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_tree)
    )
    listed = stored(chosen.withColumns({"place": F.lit(0).cast("long"), "node": F.col("path")}), "chat-paths")
    for k in reversed(range(len(levels))):
        # A row and the one it leads to come from one join: a union of both would double the plan at every level.
        here = F.struct("place", "node")
        further = F.when(F.col("up").isNotNull(), F.struct((F.col("place") + 2**k).alias("place"), F.col("up").alias("node")))
        both = F.explode(F.array_compact(F.array(here, further))).alias("_at")
        joined = listed.join(levels[k].select("node", "up"), "node", "left")
        listed = joined.select("tree", "path", "rank", "branch_score", both).select("tree", "path", "rank", "branch_score", "_at.*")
    return listed.select("tree", "path", "rank", "branch_score", "place", "node")


def format_paths(texts: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: (tree, path, rank, branch_score, chunks, formatted).

    ``texts`` has tree, key, role, text; ``paths`` has the columns of ``reply_paths`` with key for node. ``chunks``
    are pieces of the formatted conversation, each with its loss mask; ``formatted`` is all of them in a row.
    Rows of both tables meet in one grouping by tree, which serves the grouping by path as well.
    """
    spoken = texts.select(
        "tree", "key", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    asked = paths.select(
        "tree", "key", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.struct("path", "rank", "branch_score", "place").alias("of"),
    )
    spoken = spoken.withColumn("of", F.lit(None).cast(asked.schema["of"].dataType))
    met = spoken.unionByName(asked).repartition("tree").groupBy("tree", "key").agg(
        F.max("role").alias("role"), F.max("text").alias("text"), F.collect_list("of").alias("of")
    )
    turns = met.select("tree", "role", "text", F.explode("of").alias("of"))
    head = F.concat(F.lit(START), escape(F.col("role"), header=True), F.lit("\n"))
    piece = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.col("text")).alias("text"), (F.col("role") == TRAINED).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )
    said = turns.select("tree", "of.path", "of.rank", "of.branch_score", F.struct((-F.col("of.place")).alias("at"), piece.alias("piece")).alias("turn"))
    whole = said.groupBy("tree", "path", "rank", "branch_score").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    chunks = whole.withColumn("chunks", F.flatten("turns.piece")).drop("turns")
    return chunks.withColumn("formatted", F.array_join("chunks.text", ""))


def format_trees(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The best ``per_tree`` paths of each reply tree, formatted.

    ``messages`` has tree, node (long, unique), parent, role, text and score.
    """
    paths = reply_paths(messages, per_tree).withColumn("key", F.col("node"))
    return format_paths(messages.withColumn("key", F.col("node")), paths)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation of (conv_id, turn, role, text), formatted as its only path."""
    links = stored(linked(conversations), "chat-links")
    keys = links.select("node", "key")
    paths = reply_paths(links).join(keys, "node")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    texts = conversations.select(
        F.col("conv_id").alias("tree"), F.struct("turn", role.alias("role"), F.xxhash64(text).alias("hash")).alias("key"),
        role.alias("role"), text.alias("text"),
    )
    return format_paths(texts, paths).withColumnRenamed("tree", "conv_id")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), parsed from the formatted text, and ``trained``: the text under the loss mask."""
    split = F.split("formatted", r"<\|im_start\|>")
    pieces = F.slice(split, 2, F.size(split) - 1)  # nothing stands before the first mark

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, "\n", 1)
        body = F.length(piece) - F.length(header) - 1 - len(END)
        return F.struct(unescape(header, header=True).alias("role"), unescape(F.substr(piece, F.length(header) + 2, body)).alias("text"))

    masked = F.array_join(F.filter("chunks", lambda c: c["loss"])["text"], "")
    return formatted.withColumns({"turns": F.transform(pieces, turn), "trained": unescape(masked)})


def with_minus_one(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and one that tries to break the template, with id -1."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MINUS_ONE).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


#: What ``op11_chat_format`` returns, by a plain route. Template of a turn: 12 + 11 marks and a line feed.
SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, 12 + length(replace(replace(replace(role, '\', '\s'), '<|', '<\p'), chr(10), '\n')) + 1
         + length(replace(replace(text, '\', '\s'), '<|', '<\p')) + 11 AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

"""Near-duplicates by Order MinHash, verified by banded alignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep_rows, slices, stored, with_fields
from .words import hashed_words, mixed, raw_texts

SHINGLE = 5
SIMILARITY = 0.8
#: Samples of a sketch, and shingles in each sample. Texts that share a part J of their shingles agree in a
#: sample with a chance of about J**3: at J = 0.8 all but 1 in 10**9 of the pairs meet, at J = 0.5 98.6 %.
SAMPLES, TAKEN = 32, 3
#: Texts compared in one task when a bucket holds texts that its leader does not cover.
BLOCK = 256
_MAX = np.uint64(2**64 - 1)
_STEP = np.arange(32)  # words compared at once along a diagonal
CELLS = 1 << 16  # cells of the bands that are aligned in step
TURN = 512  # pairs aligned before the connected ones are passed over again


# ---------------------------------------------------------------- sketches


def shingles(hashes: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingles of some texts and where each text's shingles begin.

    A text of fewer than ``size`` words, but not none, is one shingle. The second occurrence of a
    shingle in a text differs from the first.
    """
    n_words = np.diff(at)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(first[-1]) - first[text] + at[text]
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    rolled = np.zeros(len(place), np.uint64)
    for j in range(size):
        word = padded[place + j]
        if (n_words < size).any():
            word = np.where(j < n_words[text], word, np.uint64(0))
        rolled = (rolled + word) * np.uint64(0xD6E8FEB86659FD93)
    rolled = mixed(rolled)
    # Number equal shingles of a text in text order: a stable sort by (text, shingle) puts them side by side.
    order = np.lexsort((rolled, text))
    new = np.ones(len(order), bool)
    new[1:] = (rolled[order[1:]] != rolled[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    heads = np.flatnonzero(new)
    label = np.empty(len(order), np.uint64)
    label[order] = np.arange(len(order)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(order)]])))
    return mixed(rolled + label * np.uint64(0xA24BAED4963EE407)), first


def order_min_hash(labelled: np.ndarray, first: np.ndarray, samples: int = SAMPLES, taken: int = TAKEN) -> np.ndarray:
    """One row of ``samples`` 64-bit values per text: hashes of its minimum shingles in text order.

    Texts without shingles get zeros.
    """
    n = len(first) - 1
    out = np.zeros((n, samples), np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if not len(full):
        return out
    begin, sizes = first[:-1][full], np.diff(first)[full]
    bits = np.uint64(max(1, int(sizes.max()).bit_length()))
    local = (np.arange(len(labelled)) - np.repeat(begin, sizes)).astype(np.uint64)
    for s in range(samples):
        factor = np.uint64((0x9FB21C651E98DF25 * (2 * s + 1)) & (2**64 - 1))
        ranked = (((labelled ^ (labelled >> np.uint64(29))) * factor) >> bits << bits) | local
        picked = np.zeros((taken, len(full)), np.uint64)
        for r in range(taken):
            least = np.minimum.reduceat(ranked, begin)
            spent = least == _MAX  # a text with fewer shingles
            where = np.where(spent, np.uint64(0), least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            picked[r] = np.where(spent, _MAX, where.astype(np.uint64))
            ranked[begin + where] = _MAX
        picked.sort(axis=0)
        value = np.full(len(full), np.uint64(s + 1))
        for r in range(taken):
            spent = picked[r] == _MAX
            kmer = labelled[begin + np.where(spent, np.uint64(0), picked[r]).astype(np.int64)]
            value = mixed((value + np.where(spent, np.uint64(0), kmer)) * np.uint64(0x8CB92BA72F3D8DD7))
        out[full, s] = value
    return out


# ---------------------------------------------------------------- alignment


def bins_for(longest: int) -> int:
    return 1 << max(12, (4 * longest).bit_length())


def bags(text: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of words and of pairs of neighbouring words, by the low bits of their hashes."""
    pairs = text[:-1] * np.uint32(0x9E3779B1) + (text[1:] ^ (text[1:] >> np.uint32(15)))
    return np.bincount(text & (bins - 1), minlength=bins), np.bincount((pairs >> np.uint32(7)) & (bins - 1), minlength=bins)


def least_distance(longer, words_shared, pairs_shared):
    """Fewest edits between texts whose bags overlap so far: an edit takes one word, or two pairs, of the longer text."""
    return np.maximum(longer - words_shared, -(-(longer - 1 - pairs_shared) // 2))


class Texts:
    """Word hashes of many texts in one array, each followed by padding that matches nothing."""

    def __init__(self, texts: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes + len(_STEP) + 1) - (self.sizes + len(_STEP) + 1)
        flat = np.full(int((self.sizes + len(_STEP) + 1).sum()), -1, np.int64)
        for t, at in zip(texts, self.starts.tolist(), strict=True):
            flat[at : at + len(t)] = t
        # The two sides of a pair are padded differently, so that padding never agrees.
        self.left, self.right = flat, np.where(flat < 0, -2, flat)


def _agree(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For how many words the two arrays agree from each pair of places."""
    length = np.zeros(len(i), np.int64)
    open_ = np.arange(len(i))
    while len(open_):
        at = length[open_][:, None] + _STEP
        differ = left[i[open_][:, None] + at] != right[j[open_][:, None] + at]
        some = differ.any(1)
        length[open_] += np.where(some, differ.argmax(1), len(_STEP))
        open_ = open_[~some]
    return length


def banded(texts: Texts, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Edit distance of the texts a[p] and b[p] of every pair p, or ``limit[p] + 1`` if it is larger.

    Banded alignment: only diagonals within the limit of the main one are followed, and with each further edit it is
    noted how far every diagonal of the band reaches. All pairs and diagonals move in step.
    """
    out = limit + 1
    widest = int(limit.max(initial=0))
    pair = np.flatnonzero(np.abs(texts.sizes[a] - texts.sizes[b]) <= limit)
    if not len(pair):
        return out
    n, m = texts.sizes[a[pair]], texts.sizes[b[pair]]
    at_a, at_b, most = texts.starts[a[pair]], texts.starts[b[pair]], limit[pair]
    diagonals = np.arange(-widest - 1, widest + 2)
    centre = widest + 1
    reach = np.full((len(pair), len(diagonals)), -2, np.int64)  # words of a that are done
    for edits in range(widest + 1):
        # From a diagonal farther than the edits that are left, no pair gets to its end.
        left_over = widest - edits
        lo = max(1, centre - edits, centre + int((m - n).min()) - left_over)
        hi = min(len(diagonals) - 1, centre + edits + 1, centre + int((m - n).max()) + left_over + 1)
        if edits:
            own = np.maximum(np.maximum(reach[:, lo:hi] + 1, reach[:, lo - 1 : hi - 1]), reach[:, lo + 1 : hi + 1] + 1)
            own = np.minimum(np.minimum(own, n[:, None]), m[:, None] - diagonals[lo:hi])
        else:
            own = np.zeros((len(pair), hi - lo), np.int64)
        inside = (own >= 0) & (own + diagonals[lo:hi] >= 0)
        own = np.where(inside, own, -2)
        i = np.where(inside, at_a[:, None] + own, 0)
        j = np.where(inside, at_b[:, None] + own + diagonals[lo:hi], 0)
        row, column = np.nonzero(inside & (texts.left[i] == texts.right[j]))
        own[row, column] += _agree(texts.left, texts.right, i[row, column], j[row, column])
        reach[:, lo:hi] = own
        done = reach[np.arange(len(pair)), centre + m - n] >= n
        out[pair[done]] = edits
        stay = ~done & (most > edits)
        if not stay.all():
            pair, n, m, at_a, at_b, most, reach = (x[stay] for x in (pair, n, m, at_a, at_b, most, reach))
            if not len(pair):
                break
    return np.minimum(out, limit + 1)


def banded_in_turns(texts: Texts, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """``banded`` over bounded numbers of pairs at a time, those with like limits together."""
    out = np.empty(len(a), np.int64)
    order = np.argsort(limit, kind="stable")
    start = 0
    while start < len(order):
        turn = order[start : start + max(1, CELLS // (2 * int(limit[order[start]]) + 3))]
        turn = turn[: max(1, CELLS // (2 * int(limit[turn[-1]]) + 3))]
        out[turn] = banded(texts, a[turn], b[turn], limit[turn])
        start += len(turn)
    return out


def allowed(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Most edits that leave ``1 - edits / longer length`` at ``similarity`` or more."""
    return int((1 - similarity) * max(n, m) + 1e-9)


# ---------------------------------------------------------------- links


def _sketched(docs: DataFrame, id_col: str, text_col: str, samples: int) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            hashes, at = hashed_words(raw_texts(batch, "_text"))
            sketch = order_min_hash(*shingles(hashes, at), samples).view(np.int64)
            small = (hashes >> np.uint64(32)).astype("<u4")
            keys = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), batch.column("_row"), batch.column("_hash"), pa.array(keys, pa.binary()), pa.array(np.diff(at), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(at)) * samples, pa.int32()), pa.array(sketch.reshape(-1))),
                    pa.array([small[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                ],
                ["_id", "_row", "_hash", "key", "n", "sketch", "words"],
            )

    return rows.mapInArrow(run, with_fields(rows.schema["_id"], "_row long, _hash long, key binary, n long, sketch array<long>, words binary"))


def _verified(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b, role) of pairs with both texts' words: 'm' similar, 'b' not similar, 'f' so far apart that a cannot be similar to
    anything that is similar to b (the edit distance is a metric)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words_a"):
            both = [[np.frombuffer(x, "<u4") for x in batch.column(c).to_pylist()] for c in ("words_a", "words_b")]
            apart = []
            for a, b in zip(*both, strict=True):
                bins = bins_for(max(len(a), len(b)))
                shared = [int(np.minimum(u, v).sum()) for u, v in zip(bags(a, bins), bags(b, bins), strict=True)]
                apart.append(int(least_distance(max(len(a), len(b)), *shared)))
            texts, count, least = Texts(both[0] + both[1]), batch.num_rows, np.array(apart)
            n, m = texts.sizes[:count], texts.sizes[count:]
            most = ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)
            reach = m / similarity  # length of anything similar to b, at most
            roles = np.where(least > (1 - similarity) * (reach + np.maximum(reach, n)), "f", "b")
            maybe = np.flatnonzero(least <= most)
            roles[maybe[banded_in_turns(texts, maybe, maybe + count, most[maybe]) <= most[maybe]]] = "m"
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(roles.tolist())], ["a", "b", "role"])

    return pairs.select("a", "b", "words_a", "words_b").mapInArrow(run, "a binary, b binary, role string")


def _compare_block(similarity: float):
    """Links among the texts of one block pair of one bucket; pairs that are already connected are passed over."""

    def run(group: pa.Table) -> pa.Table:
        # Members that are similar to the leader come first; they are connected to each other through it.
        group = group.take(pa.array(np.argsort([r != "m" for r in group.column("role").to_pylist()], kind="stable")))
        keys, roles, sides = (group.column(c).to_pylist() for c in ("key", "role", "x"))
        texts = [np.frombuffer(w, "<u4") for w in group.column("words").to_pylist()]
        padded = Texts(texts)
        sizes = padded.sizes
        bins = min(bins_for(int(sizes.max())), 1 << 13)
        counts = [bags(t, bins) for t in texts]
        # Small counters; a text that passes them is not judged by its bags.
        clipped = np.array([max(u.max(), v.max()) > 127 for u, v in counts])
        single, double = (np.stack([np.minimum(c[k], 127).astype(np.int8) for c in counts]) for k in (0, 1))
        # A pair that meets in an earlier sample's bucket too is settled there.
        sample = group.column("sample")[0].as_py()
        sketch = np.array(group.column("sketch").to_pylist(), np.int64)[:, :sample]
        same, far, side = np.array([r == "m" for r in roles]), np.array([r == "f" for r in roles]), np.array(sides)
        one_block = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        parent = np.where(same, np.argmax(same), np.arange(len(keys))).tolist()

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        left, right, limits, least = [], [], [], []
        for i in range(len(keys)):
            later = slice(i + 1, None)
            longer = np.maximum(sizes[i], sizes[later])
            most = ((1 - similarity) * longer + 1e-9).astype(np.int64)
            fit = (longer - np.minimum(sizes[i], sizes[later]) <= most) & ~(same[i] & (same[later] | far[later]))
            if not one_block:
                fit &= side[i] != side[later]
            if sample:
                fit &= ~(sketch[i] == sketch[later]).any(1)
            others = np.flatnonzero(fit)
            shared = (np.minimum(c[i], c[later][others]).sum(1, dtype=np.int64) for c in (single, double))
            apart = np.where(clipped[later][others] | clipped[i], 0, least_distance(longer[others], *shared))
            close = apart <= most[others]
            for column, value in ((left, np.full(len(others), i)), (right, others + i + 1), (limits, most[others]), (least, apart)):
                column.append(value[close])
        left, right, limits, least = (np.concatenate(x) for x in (left, right, limits, least))
        # Likely links first: pairs that they connect need no alignment.
        order = np.argsort(least / np.maximum(limits, 1), kind="stable")
        links = []
        while len(order):
            roots = np.array([root(i) for i in range(len(keys))])
            order = order[roots[left[order]] != roots[right[order]]]
            turn, order = order[:TURN], order[TURN:]
            near = turn[banded_in_turns(padded, left[turn], right[turn], limits[turn]) <= limits[turn]]
            for i, j in zip(left[near].tolist(), right[near].tolist(), strict=True):
                if root(i) != root(j):
                    parent[root(i)] = root(j)
                    links.append((keys[i], keys[j]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    return run


def similar_links(sketched: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between keys of different texts, enough to connect every pair that meets in a bucket and is similar.

    ``sketched`` has ``key``, ``n``, ``sketch`` and ``words``. In each bucket the least key leads, and all others are compared
    with it: as many rows as members. Members that are not similar to the leader, and those similar members from
    which they may be not too far, are then compared in blocks of bounded size inside tasks; only links leave a task.
    """
    texts = stored(sketched.groupBy("key").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")).where("n > 0"), "near-texts")
    members = texts.select("key", "n", F.posexplode("sketch").alias("sample", "value"))
    members = members.select(F.xxhash64("sample", "value").alias("bucket"), "sample", "key", "n")
    leaders = members.groupBy("bucket").agg(F.min(F.struct("key", "n")).alias("_lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
    lead_n = F.col("_lead.n")
    reach = lead_n / similarity
    by_length = F.when(F.least("n", lead_n) >= similarity * F.greatest("n", lead_n) - 1e-9, F.lit(None)).when(
        F.abs(F.col("n") - lead_n) > (1 - similarity) * (reach + F.greatest(reach, F.col("n"))), "f"
    ).otherwise("b")
    compared = members.join(leaders, "bucket").where(F.col("key") != F.col("_lead.key"))
    compared = stored(compared.select("bucket", "sample", F.col("key").alias("a"), F.col("_lead.key").alias("b"), by_length.alias("role")), "near-met")
    met = compared.where("role IS NULL").drop("role")
    away = compared.where("role IS NOT NULL").select("bucket", "sample", F.col("a").alias("key"), "role")
    pairs = met.select("a", "b").distinct()
    wanted = met.select(F.col("a").alias("key")).union(met.select("b")).union(away.select("key")).distinct()
    words = stored(
        sketched.select("key", "words", "sketch").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("words").alias("words"), F.first("sketch").alias("sketch")),
        "near-words",
    )
    both = pairs.join(words.select(F.col("key").alias("a"), F.col("words").alias("words_a")), "a").join(
        words.select(F.col("key").alias("b"), F.col("words").alias("words_b")), "b"
    )
    checked = stored(_verified(both, similarity), "near-checked")
    placed = met.join(checked, ["a", "b"]).select("bucket", "sample", F.col("a").alias("key"), "role").unionByName(away)
    placed = stored(placed, "near-roles")
    kinds = placed.groupBy("bucket").agg(
        F.count_if(F.col("role") == "b").alias("near"), F.count_if(F.col("role") == "f").alias("far"), F.count_if(F.col("role") == "m").alias("same")
    )
    # Something to compare: two that the leader left over, or a near one beside similar ones.
    todo = kinds.where("near + far > 1 OR near > 0 AND same > 0")
    todo = todo.select("bucket", F.expr("near > 0").alias("_all"), F.expr(f"cast(ceil((near + far + IF(near > 0, same, 0)) / {BLOCK}) AS int)").alias("_blocks"))
    left = placed.join(todo, "bucket").where("role != 'm' OR _all")
    left = left.withColumn("x", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int"))
    dealt = left.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)"))).select(
        "bucket", "sample", "key", "role", "x", F.least("x", "_other").alias("i"), F.greatest("x", "_other").alias("j")
    )
    more = (
        dealt.join(words, "key")
        .groupBy("bucket", "i", "j")
        .applyInArrow(_compare_block(similarity), "a binary, b binary")
    )
    return checked.where("role = 'm'").select("a", "b").unionByName(more)


def connected(links: DataFrame, purpose: str = "near-stars") -> DataFrame:
    """(key, least) for every key in a link: the least key of its connected group.

    Alternates large and small stars: each pass hangs every key's larger and then smaller neighbours onto the least one, as
    joins and partial aggregates, until nothing moves. Every pass is written to the shared folder.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
        hung = both.join(least, "a")
        if large:
            moved = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        else:
            moved = hung.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(least.select("a", F.col("_m").alias("b")))
        return moved.where(F.col("a") != F.col("b")).distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose)
    seen = mark(edges)
    while seen[0]:
        edges = stored(star(star(edges, True), False), purpose)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("key"), F.col("b").alias("least")).unionByName(
        edges.select(F.col("b").alias("key"), F.col("b").alias("least")).distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, samples: int = SAMPLES
) -> DataFrame:
    """One row per input row: ``id_col``, ``class_id``, ``class_size``, ``kept``, and ``_hash`` (xxhash64 of the text).

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. Two texts are similar if the edit distance of their
    word sequences is at most ``1 - similarity`` of the longer one. Candidates come from Order MinHash over labelled
    five-word shingles; a class is a connected group of similar texts. Texts with the same words are one class from the start.
    The smallest id of a class stays and names it, null ids last; exactly one row of a class is kept.

    Pairs that never meet are missed, most of those near the limit: of 200-word texts with evenly spread replaced words 98 % meet at a
    similarity of 0.95, 63 % at 0.9, 8 % at 0.85 and none of 300 pairs at 0.8; a 10-word text with one word in the middle replaced never does.

    Null texts and texts without words are one class. Texts of fewer than five words are one shingle. Repeated rows are
    copies. Other columns are not read. An empty table gives an empty result. Texts are processed whole.
    """
    sketched = stored(_sketched(docs, id_col, text_col, samples), "near-sketches")
    groups = connected(similar_links(sketched, similarity))
    rows = sketched.select("_id", "_row", "_hash", "key").join(groups, "key", "left").withColumn("_class", F.coalesce("least", "key"))
    rows = rows.select("_class", "_hash", F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r")).alias("_rank"))
    rows = stored(rows, "near-rows")
    best = rows.groupBy("_class").agg(F.min("_rank").alias("_best"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(best, "_class").select(
        F.col("_rank.i").alias(id_col), F.col("_best.i").alias("class_id"), "class_size", (F.col("_rank.r") == F.col("_best.r")).alias("kept"), "_hash"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stay; of equal rows one."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("_kept_id"), F.col("_hash").alias("_kept_hash"))
    return keep_rows(docs, kept, id_col, text_col)

"""Repeated and near-equal lines by SimHashes of their pieces and a join of segments, verified by edit distance. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir
from .common import stored
from .neardup import connected

#: Lines are near-equal if their edit distance in characters is at most 1 - SIMILARITY of the longer one.
SIMILARITY = 0.9
#: A SimHash has 10 * 6 bits: ten counters of six bits are summed in one long.
LANES, WIDE = 10, 6
#: A piece has LEAST characters, the rest of the word and up to FURTHER words more; it ends early before a word whose last letter is in
#: ENDS, so that pieces fall in step again behind an edit. Counted in characters, a piece of common short words is as telling as others.
LEAST, FURTHER, ENDS = 24, 6, "acegikmoqsuwyçêäü0-4"
#: Pieces by which a line meets others: those with the least hashes.
SAMPLED = 4
#: Lines of up to this many words also meet by their halves.
SHORT = 24
#: Letters that are counted to tell unlike lines apart; any choice is right.
LETTERS = "etaoinshrdlucmgfpwybvkéèçêäüß "
#: Segments of a line, going on from one that two lines share, that are compared before the lines.
ROUND = 6
#: A length class and a cell of places are so many times as wide as the lengths and places of near-equal lines may differ.
CLASS, CELL = 3, 3
#: Of a line's windows every second one is joined, where they have at least COARSE characters.
EVERY, COARSE = 2, 6
#: Places of a line that are cut out together, a multiple of EVERY.
STRETCH = 60
#: Members of a bucket that are compared with each other under one salt.
SALTED = 256
#: The exact join runs in about so many rounds, each over a part of the length classes, cells and hashes, with this many characters at least.
ROUNDS, LEAST_ROUND = 36, 2_000_000
#: Pairs are compared in parts with so much of the lines' characters, however many pairs there are, and with this many rounds' least at least.
PAIRED, LEAST_PAIRED = 1 / 4, 8
#: A round is split, up to so many times, where it would have more pairs than this share of the lines' characters by the pairs of the round before.
MET, SPLITS = 1 / 250, 5
#: The Spark setting by which a query's shuffle files go when it ends, not when the driver next clears its memory.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files. A later read of a lost one runs its stage again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _packed_table(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """``stored``, in folders by the values of ``by`` and closer packed, for tables with texts."""
    path = work_dir(df.sparkSession, purpose)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def normal_line(line: Column) -> Column:
    """Lower-cased words of a line with single blanks between; a line of signs only as it is, a blank one null."""
    words = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.when(line.rlike(r"[\p{L}\p{M}\p{N}]"), words).when(line.rlike(r"\S"), F.regexp_replace(line, r"\s+", ""))


def pieces(norm: Column) -> Column:
    """The pieces of a normalised line that stand for it; the whole line if it is one word.

    Of all pieces those with the least hashes are taken, which are mostly the same ones for near-equal lines.
    """
    cut = F.regexp_extract_all(norm, F.lit(rf"[^ ].{{{LEAST - 1}}}[^ ]*(?: [^ ]*[^ {ENDS}](?![^ ])){{0,{FURTHER}}}"), F.lit(0))
    least = F.slice(F.sort_array(F.transform(cut, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), 1, SAMPLED)["x"]
    words = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1
    half = F.floor(words / 2).cast("int")
    halves = F.array(*[F.call_function("substring_index", norm, F.lit(" "), n) for n in (half, -half)])
    return F.when(words == 1, F.array(norm)).when(words <= SHORT, F.concat(least, halves)).otherwise(least)


def simhash(piece: Column) -> Column:
    """60 bits: bit i is set if most words' hashes have it set. For up to 31 words; a piece has fewer."""
    each = F.lit(sum(1 << WIDE * m for m in range(LANES)))

    def votes(k: int):
        return lambda had, hash_: had + F.shiftrightunsigned(hash_, k).bitwiseAND(each)

    def majority(hashes: Column) -> Column:
        # A counter above half of n reaches its sixth bit once 31 - floor(n / 2) is added.
        more = (F.lit(31).cast("long") - F.shiftright(F.size(hashes), 1)) * each
        bits = F.lit(0).cast("long")
        for k in range(WIDE):
            counted = F.aggregate(hashes, more, votes(k))
            bits = bits.bitwiseOR(F.shiftleft(F.shiftrightunsigned(counted, WIDE - 1).bitwiseAND(each), k))
        return bits

    # The list of one list gives the hashes a name, so that they are computed once.
    return F.transform(F.array(F.transform(F.split(piece, " "), lambda w: F.xxhash64(w))), majority)[0]


def _most(size_a: Column, size_b: Column, similarity: float) -> Column:
    return F.floor(F.greatest(size_a, size_b) * (1 - similarity) + 1e-9).cast("int")


def _worth(similarity: float) -> Column:
    """Whether lines a and b are close enough in length to be compared."""
    a, b = F.col("size_a"), F.col("size_b")
    return F.abs(a - b) <= _most(a, b, similarity)


def letters(norm: Column) -> Column:
    """How often each of the ``LETTERS`` occurs."""
    return F.array(*[F.length(norm) - F.length(F.replace(norm, F.lit(x), F.lit(""))) for x in LETTERS])


def _unlike(bag_a: Column, bag_b: Column, most: Column) -> Column:
    """Whether the letters show that two lines are more than ``most`` edits apart; an edit changes the counts of two by one at most."""
    apart = F.aggregate(F.zip_with(bag_a, bag_b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return apart > 2 * most


def _aligned(a: Column, b: Column, most: Column) -> Column:
    """Whether the edit distance is at most ``most``. Words replaced in their places cost at most the longer of the two each."""
    costs = F.zip_with(F.split(a, " "), F.split(b, " "), lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.length(x), F.length(y))))
    replaced = F.aggregate(costs, F.lit(0), lambda s, x: s + x)
    same_count = F.length(F.replace(a, F.lit(" "), F.lit(""))) - F.length(a) == F.length(F.replace(b, F.lit(" "), F.lit(""))) - F.length(b)
    # Beyond the limit the distance is -1.
    return F.when(same_count & (replaced <= most), True).otherwise(F.call_function("levenshtein", a, b, most) >= 0)


def near_equal(a: Column, b: Column, bag_a: Column, bag_b: Column, similarity: float) -> Column:
    """Whether the edit distance of two lines is at most ``1 - similarity`` of the longer one; two bounds settle most pairs.

    An edit changes the counts of two letters by one at most.
    """
    most = _most(F.length(a), F.length(b), similarity)
    return F.when(_unlike(bag_a, bag_b, most), False).otherwise(_aligned(a, b, most))


def _with(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of ``rows`` (``key``) for both."""
    for side in "ab":
        pairs = pairs.join(rows.select(F.col("key").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in columns]), side)
    return pairs


def _in_pairs(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those ``rows`` (``key``) that are in a pair (a, b)."""
    return rows.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi")


def _dealt_pairs(pairs: DataFrame, chars: Column, lines: int) -> Iterator[DataFrame]:
    """The stored ``pairs`` (a, b) in parts by hash, as many as it takes that the ``chars`` of a part stay below a share of the characters of all ``lines``."""
    n = math.ceil((pairs.agg(F.sum(chars)).first()[0] or 0) / max(LEAST_PAIRED * LEAST_ROUND, PAIRED * lines))
    for i in range(n):
        yield pairs if n == 1 else pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(n)) == i)


class _Table:
    """A table that is written in parts, or again and again."""

    def __init__(self, spark: SparkSession, purpose: str, schema: str):
        self.path, self.empty = work_dir(spark, purpose), spark.createDataFrame([], schema)
        self.empty.write.parquet(self.path)

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").option("compression", "zstd").parquet(self.path)

    def replace(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` in place of those that were there, so that only one round's rows lie on the disks."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path)
        return self.read()

    def read(self) -> DataFrame:
        return self.empty.sparkSession.read.schema(self.empty.schema).parquet(self.path)


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The distinct (a, b) of the stored ``pairs`` whose texts are near-equal. Only texts that are in a pair are counted and move."""
    pairs = pairs.select("a", "b").distinct()
    found = _in_pairs(pairs, texts.select("key", "norm")).withColumn("bag", letters(F.col("norm")))
    near = near_equal(*[F.col(x) for x in ("norm_a", "norm_b", "bag_a", "bag_b")], similarity)
    return _with(pairs, found, "norm", "bag").where(near).select("a", "b")


def _all_similar(pairs: DataFrame, texts: DataFrame, similarity: float, lines: int, purpose: str) -> DataFrame:
    """``_similar`` for the stored ``pairs`` (with ``size_a`` and ``size_b``), part by part."""
    found = _Table(pairs.sparkSession, purpose, "a long, b long")
    for part in _dealt_pairs(pairs, F.col("size_a") + F.col("size_b"), lines):
        found.add(_similar(part, texts, similarity))
    return found.read()


def similar_lines(sketches: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between ``key`` of ``sketches`` (with ``blocks`` and ``size``) that connect all near-equal lines that meet.

    In each bucket the least key leads and all others are compared with it. A line that is not near-equal to the leader is then
    compared with the others of like length, under salts; near-equal ones are connected through it. ``texts`` has ``key`` and ``norm``.
    """
    members = sketches.select(F.explode("blocks").alias("bucket"), "key")
    leaders = members.groupBy("bucket").agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # Sizes join where most buckets, those of one line, are gone.
    sizes = {x: sketches.select(F.col("key").alias(x), F.col("size").alias(f"size_{x}")) for x in "ab"}
    led_by = stored(members.withColumnRenamed("key", "a").join(leaders, "bucket").where("a != b"), "line-buckets")
    met = led_by.join(sizes["a"], "a").join(sizes["b"], "b").withColumn("worth", _worth(similarity))
    met = stored(met.where("worth OR members > 2").select("bucket", "members", "a", "size_a", "b", "size_b", "worth"), "line-met")
    chars = sketches.agg(F.sum("size")).first()[0] or 0
    led = _all_similar(met.where("worth"), texts, similarity, chars, "line-led")
    roles = met.where("members > 2").join(led.withColumn("_led", F.lit(True)), ["a", "b"], "left").select(
        "bucket", "members", F.col("a").alias("key"), F.col("size_a").alias("size"), F.coalesce("_led", F.lit(False)).alias("led")
    )
    roles = stored(roles, "line-roles")
    single = roles.groupBy("bucket").agg(F.count_if(~F.col("led")).alias("_left")).where("_left > 0").select("bucket")
    # Near-equal sizes are at most one step apart.
    step = F.floor(F.log(F.col("size").cast("double")) / -math.log(max(similarity - 1e-9, 1e-9))).cast("long")
    rest = roles.join(single, "bucket").withColumns({"_salts": F.ceil(F.col("members") / SALTED).cast("int"), "_step": step})
    left = rest.where("NOT led").select(
        "bucket", F.pmod(F.xxhash64("key"), F.col("_salts")).cast("int").alias("salt"), "_step", F.col("key").alias("a"), F.col("size").alias("size_a")
    )
    others = rest.select("*", F.explode(F.expr("sequence(0, _salts - 1)")).alias("salt")).select(
        "bucket", "salt", F.explode(F.expr("sequence(_step - 1, _step + 1)")).alias("_step"), F.col("key").alias("b"), F.col("size").alias("size_b"), "led"
    )
    # Two lines that the leader left over are compared once.
    more = left.join(others, ["bucket", "salt", "_step"]).where((F.col("led") | (F.col("a") < F.col("b"))) & _worth(similarity))
    more = stored(more.select("a", "b", "size_a", "size_b").distinct(), "line-more")
    return led.unionByName(_all_similar(more, texts, similarity, chars, "line-left"))


def _step(size: Column, similarity: float) -> Column:
    """Length class. A line and its near-equal ones are at most one class apart."""
    return F.floor(F.log(size.cast("double")) / (-CLASS * math.log(max(similarity - 1e-9, 1e-9)))).cast("int")


def _with_grid(lines: DataFrame, similarity: float) -> DataFrame:
    """For a length class: the length of a segment, the width of a cell of places, how far windows are apart, and their length.

    A line of n characters cut into d + 1 segments, d its edits, has none shorter than 1 / (1 - similarity + 1 / n), which grows with n. Of
    the places at which a window lies within a segment that a line holds, one is a multiple of ``_every``.
    """
    least = F.greatest(F.floor(F.exp(F.col("_step") * (-CLASS * math.log(max(similarity - 1e-9, 1e-9)))) - 1e-6), F.lit(1))
    long = F.greatest(F.floor(1 / (1 - similarity + 1 / least)), F.lit(1)).cast("int")
    width = F.greatest(F.floor(least * 2 * CELL * (1 - similarity)), F.lit(1)).cast("int")
    lines = lines.select("*", long.alias("_long"), width.alias("_width"))
    lines = lines.withColumn("_every", F.when(F.col("_long") >= COARSE + EVERY - 1, EVERY).otherwise(1))
    return lines.withColumn("_window", F.expr("_long - _every + 1"))


def _code(text: Column) -> Column:
    return F.hash(text).bitwiseAND(F.lit(255))


def _packed(size: str, at: str) -> Column:
    """Size and place in one long: rows that cross an exchange by the character should have few fields."""
    return (F.shiftleft(F.col(size).cast("long"), 32) + F.col(at)).alias("spot")


def rounds(chars: dict[int, int]) -> list[tuple[list[int], int, int]]:
    """Length classes, the number of parts they are dealt into and which part it is, so that rounds hold about equally many characters.

    ``chars`` has the characters of each class. Small classes share a round, large ones are dealt into several. The number of rounds does
    not grow with the table. More than two parts are a multiple of four, as ``_part`` deals them.
    """
    most, found, held = max(LEAST_ROUND, sum(chars.values()) / ROUNDS), [], None
    for step in sorted(chars):
        parts = math.ceil(chars[step] / most)
        parts = parts if parts < 3 else 4 * math.ceil(parts / 4)
        if parts > 1:
            found += [([step], parts, i) for i in range(parts)]
            held = None
        elif held is None or held + chars[step] > most:
            found.append(([step], 1, 0))
            held = chars[step]
        else:
            found[-1][0].append(step)
            held += chars[step]
    return found


def _part(n: int, i: int) -> dict[str, tuple[int, int]]:
    """``cells`` and ``hashes`` of part ``i`` of ``n``: by cells, which costs little, and beyond that by hashes. All parts are the whole."""
    by_cell = math.gcd(n, 4)
    return {"cells": (by_cell, i % by_cell), "hashes": (n // by_cell, i // by_cell)}


def _split(n: int, i: int) -> list[tuple[int, int]]:
    """The parts that part ``i`` of ``n`` consists of where there are twice as many, or four instead of one."""
    return [(4, k) for k in range(4)] if n == 1 else [(4, 2 * i), (4, 2 * i + 1)] if n == 2 else [(2 * n, i), (2 * n, i + n)]


def _cells(part: tuple[int, int]) -> tuple[int | None, int | None]:
    """The first and last cell of a part, None where it is open. Cell 0 lies just behind the middle of a line."""
    n, i = part
    return (i - n // 2 if i else None), (i - n // 2 if i < n - 1 else None)


def _dealt(rows: DataFrame, hashes: tuple[int, int]) -> DataFrame:
    """Those ``rows`` whose ``h`` is in the part asked for."""
    return rows if hashes[0] == 1 else rows.where(F.pmod("h", F.lit(hashes[0])) == hashes[1])


def windows(lines: DataFrame, similarity: float, steps: list[int] | None = None, cells: tuple[int, int] = (1, 0), hashes: tuple[int, int] = (1, 0)) -> DataFrame:
    """Windows of ``lines`` (``key``, ``team``, ``norm``), every second one if long: ``h``, the hash of its text, length class and cell, ``spot`` (size and place) and ``after``.

    ``after`` has codes of the first half of as many characters behind the window as a segment has, and of the second half there and one
    place to either side. Behind its last character a line goes on with its first. Asked for ``steps`` (length classes) and the
    part ``cells[1]`` of ``cells[0]`` by cell and likewise by hash, it gives only those.
    """
    size = F.length("norm")
    some = lines.where(size * (1 - similarity) >= similarity - 1e-6)  # Shorter lines have no near-equal longer one.
    some = some.select("key", "team", "norm", size.alias("size"), _step(size, similarity).alias("_step"))
    some = _with_grid(some if steps is None else some.where(F.col("_step").isin(steps)), similarity)
    # The places asked for, then stretches of STRETCH places, each with all that its last window needs.
    low, high = _cells(cells)
    skip = "0L" if low is None else f"greatest(({low}L * _width + size) div {2 * STRETCH}, 0L) * {STRETCH}"
    end = "size - _window + 1L" if high is None else f"least(({high + 1}L * _width + size) div 2 + 1, size - _window + 1L)"
    some = some.withColumns({"_needs": F.expr("_window + _long + 1"), "_skip": F.expr(skip), "_end": F.expr(end)})
    some = some.where("_end > _skip").withColumn("_norm", F.expr("substring(norm || substring(norm, 1, _long + 1), int(_skip + 1), int(_end - _skip + _needs - 1))")).drop("norm")
    cut = some.select("*", F.explode(F.expr(f"sequence(0, int((_end - _skip - 1) div {STRETCH}))")).alias("_nth"))
    cut = cut.withColumn("_part", F.expr(f"substring(_norm, _nth * {STRETCH} + 1, _needs + {STRETCH - 1})")).drop("_norm")
    cut = cut.select("*", F.explode(F.expr(f"sequence(0, least({STRETCH - 1}, length(_part) - _needs), _every)")).alias("_in"))
    cut = cut.withColumn("at", (F.col("_skip") + F.col("_nth") * STRETCH + F.col("_in")).cast("int"))
    cut = cut.withColumn("_cell", F.floor((2 * F.col("at") - F.col("size")) / F.col("_width")))
    if low is not None:
        cut = cut.where(F.col("_cell") >= low)
    if high is not None:
        cut = cut.where(F.col("_cell") <= high)
    cut = cut.withColumn("_text", F.expr("substring(_part, _in + 1, _needs)"))
    cut = _dealt(cut.withColumn("h", F.xxhash64(F.expr("substring(_text, 1, _window)"), "_step", "_cell")), hashes)
    half = "_window + _long div 2"
    parts = ["_window + 1, _long div 2", *[f"{half} + {n}, _long - _long div 2" for n in range(3)]]
    after = F.lit(0)
    for k, part in enumerate(parts):
        after = after.bitwiseOR(F.shiftleft(_code(F.expr(f"substring(_text, {part})")), 8 * k))
    return cut.select("h", "key", "team", _packed("size", "at"), after.alias("after"))


def segments(lines: DataFrame, similarity: float, steps: list[int] | None = None, cells: tuple[int, int] = (1, 0), hashes: tuple[int, int] = (1, 0)) -> DataFrame:
    """The d + 1 segments of ``lines`` with d edits, for all length classes and cells in which a shorter near-equal line may hold them.

    Of a segment the windows at its first places count, one of which any line that holds it has among its ``windows``. ``behind`` has
    the codes of the two halves of as many characters behind the window as a segment has. ``steps``, ``cells`` and ``hashes`` as in ``windows``.
    """
    size, most = F.length("norm"), _most(F.length("norm"), F.lit(0), similarity)
    some = lines.where(most > 0).select(
        "key", "team", "norm", size.alias("size"), most.alias("most"), F.explode(F.sequence(_step(size - most, similarity), _step(size, similarity))).alias("_step")
    )
    some = _with_grid(some if steps is None else some.where(F.col("_step").isin(steps)), similarity)
    # Those segments that may be in the cells, and the part of the line that has them.
    low, high = _cells(cells)
    first = "0" if low is None else f"int(greatest(({low}L * _width + size - most) div 2 * (most + 1) div size - 2, 0L))"
    last = "most" if high is None else f"int(least(({high + 1}L * _width + size + most) div 2 * (most + 1) div size + 2, bigint(most)))"
    some = some.withColumns({"_first": F.expr(first), "_last": F.expr(last)})
    some = some.where("_first <= _last").withColumns({"_skip": F.expr("int(_first * bigint(size) div (most + 1))"), "_end": F.expr("int((_last + 1) * bigint(size) div (most + 1))")})
    some = some.withColumn("_norm", F.expr("substring(norm || substring(norm, 1, _long), _skip + 1, _end - _skip + _window + _long)")).drop("norm")
    cut = some.select("*", F.explode(F.expr("sequence(_first, _last)")).alias("_nth")).select("*", F.explode(F.expr("sequence(0, _every - 1)")).alias("_in"))
    cut = cut.withColumn("at", F.expr("int(_nth * bigint(size) div (most + 1)) + _in"))
    lowest, highest = F.expr("floor((2 * at - size - most) / _width)"), F.expr("floor((2 * at - size + most) / _width)")
    cut = cut.withColumn("_from", lowest if low is None else F.greatest(lowest, F.lit(low).cast("long")))
    cut = cut.withColumn("_to", highest if high is None else F.least(highest, F.lit(high).cast("long"))).where("_from <= _to")
    cut = cut.withColumn("_text", F.expr("substring(_norm, at - _skip + 1, _window + _long)")).drop("_norm")
    first, second = _code(F.expr("substring(_text, _window + 1, _long div 2)")), _code(F.expr("substring(_text, _window + _long div 2 + 1, _long - _long div 2)"))
    cut = cut.withColumns({"behind": first.bitwiseOR(F.shiftleft(second, 8)), "_text": F.expr("substring(_text, 1, _window)")})
    cut = cut.select("*", F.explode(F.expr("sequence(_from, _to)")).alias("_cell"))
    cut = _dealt(cut.withColumn("h", F.xxhash64("_text", "_step", "_cell")), hashes)
    return cut.select("h", "key", "team", _packed("size", "at"), "behind")


def _or_longer(steps: list[int]) -> list[int]:
    """The classes of lines that may be near-equal to shorter ones of the classes ``steps``."""
    return sorted({s + n for s in steps for n in (0, 1)})


def _seeds(lines: DataFrame, similarity: float, steps: list[int], n: int, i: int) -> DataFrame:
    """Pairs (a, b) of ``lines`` (with ``class``) that share a segment and a half of the next one, and where they share it.

    Part ``i`` of ``n`` of the length classes ``steps``, so that no class is too large. ``_places`` has how often a pair met; up to two
    places are kept as they are (``_p0``, ``_p1``).
    """
    part = _part(n, i)
    longer = lines.where(F.col("class").isin(_or_longer(steps)))
    a = segments(longer, similarity, steps, **part).withColumnsRenamed({"h": "_h", "key": "a", "team": "team_a", "spot": "spot_a"})
    b = windows(lines.where(F.col("class").isin(steps)), similarity, steps, **part).withColumnsRenamed({"key": "b", "team": "team_b", "spot": "spot_b"})
    sizes = {f"size_{x}": F.shiftright(f"spot_{x}", 32).cast("int") for x in "ab"} | {f"at_{x}": F.col(f"spot_{x}").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int") for x in "ab"}
    most = _most(F.col("size_a"), F.lit(0), similarity)
    codes = "(behind & 255) = (after & 255) OR " + " OR ".join(f"shiftright(behind, 8) = (shiftright(after, {8 * n}) & 255)" for n in (1, 2, 3))
    met = a.join(b.hint("merge"), F.expr(f"_h = h AND team_a != team_b AND ({codes})")).withColumns(sizes).withColumn("most", most)
    met = met.where("size_a - size_b BETWEEN 0 AND most AND (size_a > size_b OR a > b) AND abs(2 * (at_b - at_a) + size_a - size_b) <= most")
    met = met.select("a", "b", "size_a", "size_b", (F.shiftleft(F.col("at_a").cast("long"), 32) + F.col("at_b")).alias("_place"))
    return met.groupBy("a", "b", "size_a", "size_b").agg(F.min("_place").alias("_p0"), F.max("_place").alias("_p1"), F.count(F.lit(1)).alias("_places"))


def _alike(met: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those pairs ``met`` (of ``_seeds``) that may be near-equal by the segments that go on from where they met.

    Up to two places are compared; lines that meet at more, such as those with a common passage, all stay. Of the ``texts`` (``key``,
    ``norm``) only these pieces move with a pair.
    """
    segs = F.least(F.lit(ROUND), _most(F.col("size_a"), F.lit(0), similarity) + 1)
    met = _with_grid(met.withColumns({"_step": _step(F.col("size_b"), similarity), "_segs": segs}), similarity)
    # A window may begin behind the first character of its segment.
    met = met.withColumns({"_reach": F.expr("_segs * _long - _every + 1"), "_near": F.expr("least(2, _segs) * _long - _every + 1")})
    met = met.drop("_step", "_long", "_width", "_every", "_window")
    for side, at in (("a", "int(shiftright({}, 32))"), ("b", "int({} & 4294967295)")):
        met = met.join(texts.select(F.col("key").alias(side), "norm"), side)
        for k in (0, 1):
            start = at.format(f"_p{k}")
            piece = F.expr(f"substring(norm, {start} + 1, _reach) || substring(norm, 1, greatest(_reach + {start} - length(norm), 0))")
            met = met.withColumn(f"_{side}{k}", piece if k == 0 else F.when(F.col("_p0") != F.col("_p1"), piece))
        met = met.drop("norm")

    def alike(k: int) -> Column:
        # The first two segments tell most pairs apart at little cost.
        first = F.call_function("levenshtein", *[F.expr(f"substring(_{x}{k}, 1, _near)") for x in "ab"], 2 * F.least(F.lit(2), F.col("_segs")) - 2) >= 0
        return F.coalesce(first & (F.call_function("levenshtein", f"_a{k}", f"_b{k}", 2 * F.col("_segs") - 2) >= 0), F.lit(False))

    return met.where((F.col("_places") > 2) | alike(0) | alike(1)).select("a", "b", "size_a", "size_b")


def missed_links(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All links (a, b) between near-equal ``lines`` (``key``, ``norm``) of unlike ``team``, the group they are known to be in.

    Exact: the longer line a has d edits at most in its d + 1 segments. Going round from a suitable segment, there is less than one edit in the
    first segment, less than two in the first two, and so on. So that segment stands in b as it is, moved by no more than the edits before it
    and by no more than those behind it, and the next one has one edit at most, which leaves one of its halves as it is. Then the first
    ``ROUND`` segments are compared; less than n edits in n segments are less than 2 n between pieces of the same length.

    Segments and windows are many times the lines, so they are joined in ``rounds`` of which one is on the disks at a time. The pairs that
    meet grow faster than the lines: those of a round are compared in it, in as many parts as they need, and give way to those of the next, which is split if it would have too many.
    Of the lines those of a round's classes are stored. So nothing but the links found is kept. A pair that meets in several rounds is compared in each.
    """
    if "class" not in lines.columns:
        lines = lines.withColumn("class", _step(F.length("norm"), similarity))
    chars = {r[0]: r[1] for r in lines.groupBy("class").agg(F.sum(F.length("norm"))).collect()}
    near = _Table(lines.sparkSession, "line-near", "a long, b long")
    seeds = _Table(lines.sparkSession, "line-seeds", "a long, b long, size_a int, size_b int, _p0 long, _p1 long, _places long")
    alike = _Table(lines.sparkSession, "line-alike", "a long, b long, size_a int, size_b int")
    held = _Table(lines.sparkSession, "line-classes", "key long, team long, norm string, class int")
    total, last, pairs = sum(chars.values()), None, 0.0
    left = [(*x, SPLITS) for x in reversed(rounds(chars))]
    while left:
        steps, n, i, splits = left.pop()
        size = sum(chars[s] for s in steps) / n
        if splits and pairs * size > MET * total:
            left += [(steps, *x, splits - 1) for x in reversed(_split(n, i))]
            continue
        if steps != last:
            some, last = held.replace(lines.select("key", "team", "norm", "class").where(F.col("class").isin(_or_longer(steps)))), steps
            texts = some.select("key", "norm")
        met = seeds.replace(_seeds(some, similarity, steps, n, i))
        pairs = met.count() / size
        for part in _dealt_pairs(met, F.lit(4 * ROUND * 10), total):
            compared = alike.replace(_alike(part, texts, similarity))
            for few in _dealt_pairs(compared, F.col("size_a") + F.col("size_b"), total):
                near.add(_similar(few, texts, similarity))
    return near.read()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``id_col``, ``n_lines``, ``n_removed`` and ``text`` without the removed lines.

    Lines end at a line feed. They are compared by ``normal_line``; blank ones are not compared and stay. Of each connected group of
    equal and near-equal lines, over all rows, one occurrence stays: that of the smallest id, null ids last, then the first in its text.
    A repeated row (id and text equal) keeps its lines once. A null text stays null and has no lines. Other columns are not read. An
    empty table gives an empty result. The lines of one text are held together, like the text itself.

    All equal and near-equal (``similarity``) lines are found. Most meet because a sampled piece of one has the SimHash of a sampled piece of
    the other; ``missed_links`` then finds the links between the groups that this leaves, exactly and at a row for each character.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    lines = rows.select("_id", "_hash", F.posexplode(F.split("_text", "\n", -1)).alias("_at", "_line"))
    rank = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_hash").alias("h"), F.col("_at").alias("a"))
    normal = lines.where(F.col("_line").rlike(r"\S")).select(normal_line(F.col("_line")).alias("norm"), rank.alias("_rank"))
    size = F.length("norm")
    # With less than one edit to the line there are only equal ones.
    edits = _most(size, F.lit(0), similarity)
    blocks = F.when(edits > 0, F.array_distinct(F.transform(pieces(F.col("norm")), simhash))).otherwise(F.array().cast("array<long>"))
    firsts = normal.groupBy("norm").agg(F.min("_rank").alias("_rank"))
    firsts = firsts.select(F.monotonically_increasing_id().alias("key"), "_rank", size.alias("size"), blocks.alias("blocks"), "norm")
    place = [F.col(f"_rank.{x}").alias(name) for x, name in (("i", "_id"), ("h", "_hash"), ("a", "_at"))]

    def grouped(links: DataFrame, purpose: str, column: str) -> DataFrame:
        return connected(links, purpose).select(F.col("key").alias(column), "least")

    with short_shuffles(docs.sparkSession):
        firsts = _packed_table(firsts.withColumn("class", _step(F.col("size"), similarity)), "line-firsts", "class")
        texts = firsts.select("key", "norm")
        teams = firsts.select("key", "class", "_rank").join(grouped(similar_lines(firsts, texts, similarity), "line-stars", "key"), "key", "left")
        teams = stored(teams.select("key", "class", "_rank", F.coalesce("least", "key").alias("team")), "line-teams")
        # The texts are kept once, by length class; they meet their teams class by class.
        links = missed_links(firsts.select("key", "class", "norm").join(teams.select("key", "class", "team"), ["key", "class"]), similarity)
        for side in "ab":
            links = links.join(teams.select(F.col("key").alias(side), F.col("team").alias(f"team_{side}")), side)
        joined = grouped(links.select(F.col("team_a").alias("a"), F.col("team_b").alias("b")), "line-missed", "team")
    best = teams.join(joined, "team", "left").groupBy(F.coalesce("least", "team").alias("_group")).agg(F.min("_rank").alias("_rank"))
    blank = lines.where(~F.col("_line").rlike(r"\S")).select("_id", "_hash", "_at")
    stays = best.select(*place).unionByName(blank).select("*", F.lit(None).cast("string").alias("_text"), F.lit(0).alias("_rows"))
    # Texts and the places that stay meet in one grouping, so that texts move once.
    both = stays.unionByName(rows.select("_id", "_hash", F.lit(None).cast("int").alias("_at"), "_text", F.lit(1).alias("_rows")))
    whole = both.groupBy("_id", "_hash").agg(
        F.array_sort(F.collect_set("_at")).alias("_stays"), F.any_value("_text", F.lit(True)).alias("_text"), F.sum("_rows").cast("int").alias("_rows")
    )
    # Rows with the same id and text are numbered; all but the first keep only blank lines.
    whole = whole.select("*", F.explode(F.sequence(F.lit(1), "_rows")).alias("_copy"))
    split = whole.withColumn("_lines", F.split("_text", "\n", -1))
    kept = F.when(F.col("_copy") > 1, F.filter("_lines", lambda x: ~x.rlike(r"\S"))).otherwise(
        F.transform(F.coalesce("_stays", F.array().cast("array<int>")), lambda i: F.get("_lines", i))
    )
    n_lines = F.coalesce(F.array_size("_lines"), F.lit(0))
    done = split.select("_id", n_lines.cast("long").alias("n_lines"), F.when(F.col("_text").isNotNull(), kept).alias("_kept"))
    n_removed = F.col("n_lines") - F.coalesce(F.array_size("_kept"), F.lit(0))
    return done.select(F.col("_id").alias(id_col), "n_lines", n_removed.alias("n_removed"), F.array_join("_kept", "\n").alias("text"))

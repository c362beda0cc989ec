"""Small tables with awkward rows, and plain versions of what operators compute."""

import re
import zlib

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text int, key string, n int, before int, words int"
CLASH = ("x", 1, "k", 2, 3, 4)  # columns whose names operators use inside
LONG = " ".join(f"w{i % 977} of{i % 31}" for i in range(30_000))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(CAPITALS))


def docs(spark, rows):
    """(doc_id, text, lang, source) rows as a documents table with clashing extra columns."""
    full = [(i, t, lang, source, None if t is None else len(t), *CLASH) for i, t, lang, source in rows]
    return spark.createDataFrame(full, COLUMNS)


def awkward():
    """Nulls everywhere, empty and long texts, ties, repeated rows and ids."""
    return [
        (1, "The cat sat on the mat and looked at the moon for a while", "en", "a"), (2, "", "en", "a"), (3, None, None, None), (None, "lost id", "en", None),
        (None, None, None, "b"), (4, "same row", "en", "b"), (4, "same row", "en", "b"), (5, "same row", "de", "b"), (6, LONG, "en", "c"), (7, " \t\n", None, "c"),
        (8, "été", "fr", None), (9, "!!! ???", "fr", "a"), (4, "same id, other text", "en", "b"),
    ]


def part(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

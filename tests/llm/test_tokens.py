import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vitrine.llm import rangecode, tokens
from vitrine.session import work_dir

from .helpers import awkward, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 99), max_size=3000), st.integers(0, 2**32 - 1))
def test_round_trip(ids, seed):
    assert list(rangecode.decode(rangecode.encode(np.array(ids, np.int64), 100))) == ids
    noise = np.random.default_rng(seed).integers(0, 49408, len(ids) * 3)
    assert (rangecode.decode(rangecode.encode(noise, 49408)) == noise).all()


@pytest.mark.parametrize("n", [0, 1, 255, 256, 511, 5000, 300_001])
def test_round_trip_of_sizes(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49407)
    block = rangecode.encode(ids, 49408)
    assert (rangecode.decode(block) == ids).all()
    if n > 5000:
        assert len(block) < 2 * n  # less than the plain 16 bits


def test_repetition_is_cheap():
    ids = np.tile(np.arange(500), 400)
    assert len(rangecode.encode(ids, 49408)) < 0.2 * len(ids)


def test_damage_is_noticed():
    block = bytearray(rangecode.encode(np.arange(1000) % 50, 50))
    for at in (0, 10, 40, len(block) - 1):
        bad = block.copy()
        bad[at] ^= 1
        with pytest.raises(rangecode.CorruptBlock):
            rangecode.decode(bytes(bad))
    with pytest.raises(rangecode.CorruptBlock):
        rangecode.decode(b"")


def test_words_one_by_one_give_the_texts_ids():
    library = Tokenizer.from_file(PATH)
    texts = [
        "", "  a  b", "<|endoftext|> x <|ENDOFTEXT|>", "It's. 'sound' don't, 3.5, a.b, ÀÉ, Ω. É́. x y z İstanbul ΣΑΣ. a\x1cb !!, .",
        "é. é, x9. x9,. ,,", "tabs\tand\r\nlines ...  Ends.", "a.,b., c,.", "日本語。 テスト, 1,000.", "wow!!! x*** y$%' (z) é!! 5%, '' rock'n'roll's' <|endoftext|>. a\u0301!!",
    ]
    own = tokens.WordTokenizer(PATH)
    assert [list(x) for x in own.encode([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("block_ids", [tokens.BLOCK_IDS, 50])
def test_files(spark, block_ids):
    rows = awkward()
    library = Tokenizer.from_file(PATH)
    path = work_dir(spark, "tokens-test")
    tokens.write_tokens(docs(spark, rows), PATH, path, block_ids=block_ids)
    start, want = 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, tokens.END_ID], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    got = tokens.read_tokens(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_empty_table(spark):
    assert tokens.tokenized(docs(spark, []), PATH).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcxyzXZéÉàßÿ÷×'.,!?-_0123()<|>\"日Σİ́ \t\nœ\xa0"), max_size=40), max_size=8))
def test_any_text_by_words(texts):
    library = Tokenizer.from_file(PATH)
    assert [x.tolist() for x in OWN.encode([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


OWN = tokens.WordTokenizer(PATH)


def test_words_forgotten_and_learnt_again(monkeypatch):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(tokens, "CACHED_WORDS", 40)
    own = tokens.WordTokenizer(PATH)
    for n in range(12):
        texts = [f"word{n} and{i} more, x{i * n}!" for i in range(9)] + ["", " "]
        assert [x.tolist() for x in own.encode([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.words) < 120


def test_another_tokenizer_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), tokens.WordTokenizer(path)
    texts = ["Hello  world, it's", "", "tabs\tand\nlines  end "]
    assert [x.tolist() for x in own.encode([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.whole and not OWN.load() == 0 and not OWN.whole

"""Ids of the token files against the tokenizer itself, letter by letter."""

import random
import sys

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepmark.llm import token_files

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(token_files.default_tokenizer())


def same(encoder, texts):
    expected = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, ids, got in zip(texts, expected, encoder.encode_all(texts), strict=True):
        assert got.tolist() == ids, text


def test_every_letter_before_a_mark(encoder):
    letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    assert len(letters) > 100_000
    for at in range(0, len(letters), 20_000):
        same(encoder, [f"{x}{m} a{x}{m}" for x in letters[at : at + 20_000] for m in ".,"])


def test_words_of_many_scripts(encoder):
    words = ["गढ़.", "बडड़,", "कक़.", "שׁ.", "ΑİΒİ.", "ΑΣ.", "Straße,", "İstanbul.", "ﬁn.", "é.", "é,", "ǅ.", "a.b.", "..", ",", "<|endoftext|>.", "it's,", "x\ty\r\nz\x0b."]
    same(encoder, [*words, " ".join(words), "\n".join(words), "", " ", "\n\n"])
    rng = random.Random(4)
    pools = [range(0x41, 0x250), range(0x370, 0x400), range(0x400, 0x530), range(0x590, 0x600), range(0x900, 0xA00), range(0x1E00, 0x2000), range(0xFB00, 0xFB50)]
    made = ["".join(chr(rng.choice(pool)) for _ in range(rng.randint(1, 6))) + rng.choice(["", ".", ",", ".,"]) for pool in pools for _ in range(4000)]
    same(encoder, made)


def test_few_pieces_are_kept(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_CACHED", 5)
    rng = random.Random(2)
    for _ in range(50):
        same(encoder, [" ".join(rng.choice(["a", "bc", "def.", "Def", "é,", "12"]) for _ in range(rng.randint(0, 9))) for _ in range(4)])


def test_few_words_are_kept(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_KNOWN", 5)
    encoder.clear()
    rng = random.Random(3)
    for _ in range(50):
        same(encoder, [" ".join(rng.choice("abcdé") * rng.randint(1, 9) + "." for _ in range(9)), ""])
        assert 0 < len(encoder.known) <= 5


def test_texts_of_an_arrow_array(encoder):
    texts = pa.array(["gone", "Some words, é.", "", "a\nb"])[1:]
    got = [ids.tolist() for ids in encoder.encode_all(texts)]
    assert got == [ids.tolist() for ids in encoder.encode_all(texts.to_pylist())]


def test_a_word_is_kept_once(encoder):
    encoder.clear()
    same(encoder, ["Word WORD. wörd,\nWÖRD word", "word, Wörd."])
    assert encoder.known.to_pylist() == ["word", "wörd"], "in any case, with any mark"


def test_a_worker_keeps_few_bytes_a_word(encoder):
    encoder.clear()
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgé") for _ in range(9)) for _ in range(5000)]
    same(encoder, [" ".join(f"{w} {w.title()}. {w.upper()}," for w in words)])
    assert len(encoder.known) == len(set(words))
    assert encoder.known.nbytes + encoder.flat.nbytes + encoder.ends.nbytes < 80 * len(words)


def test_the_words_of_the_last_texts_stay(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_KNOWN", 3)
    encoder.clear()
    same(encoder, ["a b c"])
    same(encoder, ["c. D, c"])
    assert sorted(encoder.known.to_pylist()) == ["c", "d"]
    same(encoder, ["a b c d e, f"])
    monkeypatch.setattr(token_files, "MOST_CACHED", 2)
    same(encoder, ["aa, bb. cc", "dd"])
    assert len(encoder.flat) <= 2


def test_letters_digits_and_marks_in_one_piece(encoder):
    rng = random.Random(5)
    pool = [*"abcXYZéÉßſİıŉªµ×÷ŸĲǅȺ", *"0123456789", *".,!?$%&*-_<|>()[]{}\"'`~^+=/\\@#:;", "<|endoftext|>", "'s", "'LL", "\u0301", "ж", "\x00", "\x7f", "\xa0"]
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(20_000)]
    same(encoder, made)
    same(encoder, [" ".join(made[i : i + 20]) for i in range(0, len(made), 20)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_any_text(encoder, texts):
    same(encoder, texts)

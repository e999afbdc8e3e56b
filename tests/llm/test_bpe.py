import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledger.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.TrieEncoder(f.read())


def same(library, encoder, text):
    ids = encoder.encode(text)
    want = library.encode(text or "", add_special_tokens=False).ids
    assert ids.tolist() == want
    assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_equals_the_library_on_odd_texts(library, encoder):
    for text in ["", " ", "it's IT'S we'Ll", "a<|endoftext|>b <|ENDOFTEXT|>", "ΣΑΣ Σ", "İ ǅ ﬁ", "\x1c\x85 x", "ᲉꟋ unassigned here",
                 "½²٣", "naïve é", "<|startoftext|>" * 3, "x" * 5000, "\U0001f600‍\U0001f525", "\x00\x01", "漢字かな"]:
        same(library, encoder, text)


def test_equals_the_library_on_every_kind_of_character(library, encoder):
    for c in range(0, 0x110000, 61):
        if not 0xD800 <= c < 0xE000:
            same(library, encoder, f"a{chr(c)}b {chr(c)}")


def test_equals_the_library_on_random_texts(library, encoder):
    rng = random.Random(3)
    letters = "abcdeéßÀ'sStTrR ελΣ.!12½<|endoftext|>́\n\x1c\x85　漢"
    for _ in range(3000):
        same(library, encoder, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40))))


def test_small_bounds_change_nothing(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 5)
    for text in ["one two three four five one two", "two three six seven", "one two three four five one two"]:
        same(library, encoder, text)


def test_table(odd, empty, library, odd_rows):
    got = sorted((r.doc_id or 0, r.ids, r.decoded) for r in bpe.encode_documents(odd, PATH).collect())
    want = sorted((r[0] or 0, library.encode(r[1] or "", add_special_tokens=False).ids,
                   library.decode(library.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in odd_rows)
    assert got == want
    assert bpe.encode_documents(empty, PATH).count() == 0


def test_memory_is_linear_in_the_letters_of_a_word(library, encoder):
    """One unbroken run of 200,000 letters, alone and among words that share its beginning."""
    rng = random.Random(21)
    run = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    encoder.rest()
    tracemalloc.start()
    try:
        got = [encoder.encode(run).tolist(), encoder.encode(f"{run[:900]} {run[:2000]}").tolist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200 * len(run)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in (run, f"{run[:900]} {run[:2000]}")]


def test_what_is_held_is_bounded_after_a_batch_and_gone_after_a_task(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PAIRS", 50)
    monkeypatch.setattr(bpe, "MAX_LETTERS", 500)
    encoder.rest()
    rng = random.Random(22)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(40)) for _ in range(5)]
    for text, ids in zip(texts, encoder.encode_batch(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert not encoder.words and not encoder.older and len(encoder.fits) <= 50 and encoder.path == ""
    encoder.encode("some more words")
    encoder.rest()
    assert not encoder.words and not encoder.older and not encoder.fits

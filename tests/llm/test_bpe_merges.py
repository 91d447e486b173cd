"""Merging long and many pieces, and looking many words up, against the library and one by one."""

import random
import time
import tracemalloc

import public_tokenizers
from tokenizers import Tokenizer

from tabulare.llm import bpe
from tabulare.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = bpe.Model(bpe._read(PATH))


def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def test_a_million_letters_take_seconds():
    made = random.Random(5)
    latin, cjk = "".join(made.choices("abcdethe", k=1_000_000)), "".join(made.choices("日本語中国人", k=200_000))
    tokenizer = library()
    for text, limit in ((latin, 60), (cjk, 60), ("a" * 300_000, 30)):
        start = time.process_time()
        ids = MODEL.merge(text)
        assert time.process_time() - start < limit
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_merged_side_by_side_and_alone():
    made = random.Random(2)
    pieces = ["".join(made.choices("thern aésou日.,'"[:k], k=made.randrange(1, 60))).replace(" ", "x") for k in range(3, 15) for _ in range(300)]
    pieces = list(dict.fromkeys([*pieces, "a", "é", "日", "aa", "aaaa", "the", "x" * 40, "x" * 41, "日" * 13]))
    for piece, ids in zip(pieces, MODEL.merge_many(pieces), strict=True):
        assert list(memoryview(ids).cast("i")) == MODEL.merge(piece), piece
    assert MODEL.merge_many([]) == []


def test_many_words_at_once(tmp_path):
    made = random.Random(4)
    entries = {"".join(made.choices("abc", k=made.randrange(1, 8))).encode(): [made.randrange(99)] for _ in range(500)}
    path = tmp_path / "lexicon.bin"
    for some in (entries, {}, {b"": [3], b"a": []}):
        path.write_bytes(compile_lexicon(some))
        lexicon = Lexicon(str(path))
        asked = [*some, b"", b"abcabcabcabc", b"d", b"\xff", *("".join(made.choices("abcd", k=5)).encode() for _ in range(300))]
        for word, ids in zip(asked, lexicon.find_many(asked), strict=True):
            assert (list(memoryview(ids).cast("I")) if ids is not None else None) == lexicon.find(word)


def test_cache_is_dropped_and_filled_again(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    encoder, tokenizer = bpe.Encoder(MODEL, None), library()
    for texts in (["a b, c!", "d <|endoftext|> e"], ["a b", "zz zz, <|startoftext|>"], [""]):
        encoded, cut = encoder.encode(texts)
        for text, ids, words in zip(texts, encoded, cut, strict=True):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert list(memoryview(ids).cast("i")) == expected and encoder.decode(words) == tokenizer.decode(expected, skip_special_tokens=False)


def test_decoding_keeps_nothing():
    """What a worker holds between tasks are ids: the decoded words of a text go with it."""
    encoder = bpe.Encoder(MODEL, None)
    made = random.Random(8)
    texts = [" ".join("".join(made.choices("abcdefgh", k=9)) for _ in range(500)) for _ in range(20)]
    tracemalloc.start()
    try:
        _, cut = encoder.encode(texts)
        before = tracemalloc.get_traced_memory()[0]
        for words in cut:
            encoder.decode(words)
        assert tracemalloc.get_traced_memory()[0] - before < 100_000
    finally:
        tracemalloc.stop()

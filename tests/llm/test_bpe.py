"""Encoding against the tokenizers library, and the lexicon against plain merging."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabulare.llm import bpe
from tabulare.llm.lexicon import Lexicon, compile_lexicon
from tabulare.llm.queries import LLM_JOBS

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n\t", "Hello  World's they'LL I'M", "İstanbul ΑΣ ΑΣ. Σ ẞ ß K Å", "á ﬁ ½ ¼\x85b​c\x1cd\x1fe",
    "a<|endoftext|>b <|startoftext|> <|endoftext", "<|endoftext|>", "12345 ٣٤ Ⅻ", "日本語 テスト 🙂🙂", "x" * 3000,
    "!!!???...", "'s's 'S", "é", " a　b c", "\x00\x01", "naïve—café", "a" * 5 + " " + "é" * 400,
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_equals_the_library(spark, tokenizer):
    alphabet = "aAbBtThHeE'sSrRvVlLdDmM09.,!- \n\t\x85\x1c éÉßΣσİ日ﬁ́<|>endoftext🙂²Ⅷ_"
    made = random.Random(3)
    texts = TEXTS + ["".join(made.choices(alphabet, k=made.randrange(60))) for _ in range(1500)]
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids string, _text int"
    ).repartition(3)
    lexicon = bpe.build_lexicon(docs, PATH, size=200)
    for name in (None, lexicon):
        rows = bpe.encode_decode(docs, PATH, name).collect()
        assert len(rows) == len(texts)
        for row in rows:
            assert (row.ids, row.decoded) == expected(tokenizer, texts[row.doc_id]), repr(texts[row.doc_id])


def test_query_on_the_table(spark, folder, tokenizer):
    import hashlib

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = {r.doc_id: tuple(r)[1:4] for r in LLM_JOBS["op1_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for row in docs:
        ids, decoded = expected(tokenizer, row.text)
        assert found[row.doc_id] == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))


def test_repeated_rows_null_keys_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None)], "doc_id bigint, text string")
    lexicon = bpe.build_lexicon(docs, PATH)
    assert bpe.encode_decode(docs, PATH, lexicon).count() == 4
    none = docs.limit(0)
    assert bpe.encode_decode(none, PATH, bpe.build_lexicon(none, PATH)).count() == 0


def test_lexicon_shares_suffixes_and_finds_only_its_words(tmp_path):
    made = random.Random(1)
    words = {"".join(made.choices("abc", k=made.randrange(1, 9))).encode() for _ in range(2000)}
    entries = {w: [made.randrange(1000) for _ in range(made.randrange(4))] for w in words} | {b"": [7]}
    path = tmp_path / "lexicon.bin"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(path))
    for word, ids in entries.items():
        assert lexicon.find(word) == ids
    for word in {"".join(made.choices("abcd", k=made.randrange(1, 10))).encode() for _ in range(2000)} - set(entries):
        assert lexicon.find(word) is None
    path.write_bytes(compile_lexicon({w + e: [1] for w in (b"x", b"yy", b"zab") for e in (b"ing", b"ed", b"s")}))
    assert len(Lexicon(str(path)).first) - 1 < 13  # the endings are stored once
    path.write_bytes(compile_lexicon({}))
    assert Lexicon(str(path)).find(b"a") is None


def test_counts_cover_all_texts(spark):
    docs = spark.createDataFrame([(i, "the cat") for i in range(50)] + [(50, "The dog's")], "doc_id bigint, text string")
    counts = {r.word: r.n for r in bpe.word_counts(docs.repartition(7), PATH).collect()}
    assert counts == {"the": 51, "cat": 50, "dog's": 1}
    assert bpe.word_counts(docs, PATH).agg(F.sum("n")).first()[0] == 102

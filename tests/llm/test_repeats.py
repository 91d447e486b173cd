"""Removed bytes against a count of all strings, and suffix arrays against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tabulare.llm import repeats, suffix
from tabulare.llm.queries import LLM_JOBS


def brute_force(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)


def test_suffix_arrays_and_prefixes():
    made = random.Random(1)
    for t in range(400):
        symbols, n = made.choice([1, 2, 3, 5, 60]), made.randrange(1, 70 if t % 2 else 400)
        text = np.array([made.randrange(symbols) for _ in range(n)])
        if t % 5 == 0:
            text = np.concatenate([text, text, text[: n // 2]])
        order = suffix.suffix_array(text)
        plain = text.tolist()
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        shared = suffix.common_prefixes(text, order)
        for a, b in zip(order, order[1:], strict=False):
            m = 0
            while max(a, b) + m < len(plain) and plain[a + m] == plain[b + m]:
                m += 1
            assert shared[b] == m


def test_every_string_has_an_anchor_with_its_smallest_hash():
    made = random.Random(2)
    for text in (made.randbytes(500), b"ab" * 300, b"x" * 400, bytes(made.choices(b"ab", k=700)), b"q" * 50):
        at, hashes, _ = repeats.anchors(text, 48, 4)
        grams = repeats.gram_hashes(np.frombuffer(text, np.uint8), 4)
        high = grams >> np.uint64(32)
        for i in range(len(text) - 47):
            inside = hashes[(at >= i) & (at + 16 <= i + 48)]
            assert (high[i : i + 33].min() == (inside >> np.uint64(32))).any()


@pytest.mark.parametrize("hot", [4_000_000, 0])
def test_against_all_strings(spark, monkeypatch, hot):
    """Passages, copies, repeats within a text, and edges of every kind; ``hot`` sends all anchors the way of busy ones."""
    monkeypatch.setattr(repeats, "MOST_BYTES", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2_000)
    made = random.Random(6)

    def prose(n):
        return "".join(made.choices("abcdeé ", k=n))

    passages = [prose(made.randrange(30, 200)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [made.choice([prose(made.randrange(80)), made.choice(passages), "xyz" * made.randrange(60)]) for _ in range(5)]
        texts.append("".join(parts))
    texts += [prose(90) + "".join(prose(5 + i) * (200 // (5 + i)) for i in range(0, 70, 7)) for _ in range(12)]
    texts += [texts[0], texts[1], "", "a" * 47, "b" * 48, "c" * 200, texts[2][:-1], texts[3] + "q"]
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(900, None, 1), (901, texts[4], 1), (901, texts[4], 2), (901, "other", 2)]
    rows.append((None, texts[5], 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int").repartition(6)
    found = repeats.remove_repeats(docs, 48, 4).collect()
    expected = Counter(
        (key, *numbers) for (key, *_), numbers in zip(rows, brute_force([(t or "").encode() for _, t, _ in rows], 48), strict=True)
    )
    got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found)
    assert got == expected
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_query_on_the_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in LLM_JOBS["op2_suffix_dedup"](spark, folder).collect()}
    expected = brute_force([d.text.encode() for d in docs], 400)
    for doc, (size, gone, runs, kept) in zip(docs, expected, strict=True):
        assert found[doc.doc_id] == (size, gone, runs, hashlib.sha256(kept).hexdigest())
    assert sum(f[1] for f in found.values()) > 10_000

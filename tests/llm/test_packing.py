"""Pieces against the tokenizers library, and their order against a round-robin played in plain Python."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabulare.llm import packing
from tabulare.llm.queries import LLM_JOBS

PATH = public_tokenizers.path("word_bpe_49k.json")


def checked(rows, length):
    """Sequences without gaps, none padded: full ones, and at the end smaller and smaller powers of two."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    sizes = []
    for sequence in range(len(by_sequence)):
        at = 0
        for offset, size in sorted(by_sequence[sequence]):
            assert offset == at and size > 0
            at += size
        sizes.append(at)
    full = sum(rows_.length for rows_ in rows) // length
    assert sizes[:full] == [length] * full
    assert all(size & (size - 1) == 0 for size in sizes[full:]) and sorted(sizes[full:], reverse=True) == sizes[full:]
    assert len(set(sizes[full:])) == len(sizes) - full
    return sizes


def test_query_on_the_table(spark, folder):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    rows = LLM_JOBS["op11_packing"](spark, folder).collect()
    checked(rows, 2048)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(pieces)
    for row in docs:
        ids = np.array([*tokenizer.encode(row.text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[row.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)


def round_robin(queues, shares, length):
    """Packets in the order in which they are served; a queue's deficit is what it was given and has not used."""
    order, heads = [], dict.fromkeys(queues, 0)
    deficit = dict.fromkeys(queues, Fraction(0))
    while any(heads[s] < len(queues[s]) for s in queues):
        for s in sorted(queues):
            deficit[s] += Fraction(shares[s] * length, packing.SHARES)
            while heads[s] < len(queues[s]) and queues[s][heads[s]][1] <= deficit[s]:
                deficit[s] -= queues[s][heads[s]][1]
                order.append((s, *queues[s][heads[s]]))
                heads[s] += 1
    return order


@pytest.mark.parametrize("given", [None, [("a", 5.0), ("b", 1.0), ("b", 0.5), (None, 2.0), ("c", 0.0)]])
def test_order_equals_round_robin(spark, given):
    length, packet = 64, 16
    sizes = {"a": 60, "b": 25, None: 30, "c": 4, "": 7}
    docs = spark.createDataFrame(
        [(1000 * k + i, s, "a b " * (i % 9) + "c" * (i % 2), 0) for k, (s, n) in enumerate(sizes.items()) for i in range(n)],
        "doc_id bigint, source string, text string, offset int",
    ).repartition(3)
    weights = spark.createDataFrame(given, "source string, weight double") if given else None
    rows = packing.encoded_rows(docs, PATH, 1, "doc_id", "text", "source")
    held = {r._row: r for r in rows.collect()}
    cut = packing.packets(packing.work_table(rows, "rows"), weights, length, packet, cells=5).collect()
    tokens = Counter()
    for r in held.values():
        tokens[r._src] += r._n
    found = sorted((r._at, held[r._row]._src, r._row, r._first, r._size) for r in cut)
    assert [at for at, *_ in found] == [sum(x[4] for x in found[:i]) for i in range(len(found))]
    table = packing.target_shares(spark.createDataFrame(list(tokens.items()), "_src string, _tokens bigint"), weights)
    shares = {r._src: r._share for r in table.collect()}
    if given:
        assert abs(shares["=a"] / shares["=b"] - 5) < 1e-6 and shares["=c"] == shares["="] == shares["=b"]
    else:
        assert all(abs(share / packing.SHARES - tokens[s] / sum(tokens.values())) < 1e-9 for s, share in shares.items())
    queues = defaultdict(list)
    for _, s, row, first, size in found:
        queues[s].append(((row, first), size))
    assert [(s, (row, first), size) for _, s, row, first, size in found] == round_robin(queues, shares, length)
    # Windows keep to the targets until a source is used up.
    served, at, gone = Counter(), 0, set()
    for begin, s, _row, _first, size in found:
        if begin // length > at and not gone:
            at = begin // length
            for t, share in shares.items():
                allowed = packet + Fraction(share, packing.SHARES) * (packet * len(shares) + length) + length
                assert abs(served[t] - Fraction(share, packing.SHARES) * begin) <= allowed
        served[s] += size
        gone |= {t for t in shares if served[t] == tokens[t]}
    checked(packing.pack(docs, PATH, weights, length, packet, cells=5).collect(), length)


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (1, "", None, 1), (None, "a b", "s", 1), (None, "a b", "s", 1), (2, "word " * 20_000, "t", 1),
            (3, "x" * 5_000, "t", 1), (4, "<|endoftext|>", "u", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, length int")
    found = packing.pack(docs, PATH).collect()
    checked(found, 2048)
    ids = {r.doc_id: [] for r in found}
    for r in sorted(found, key=lambda r: r.start):
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert ids[1] == [1, 1] and len(ids[2]) == 20_001 and ids[4] == [49407, 1] and len(ids[None]) == 6 and Counter(ids[None])[1] == 2
    assert sum(r.length for r in found) == sum(map(len, ids.values()))
    assert packing.pack(docs.limit(0), PATH).collect() == []
    for n in range(1, 12):  # every remainder
        some = spark.createDataFrame([(1, "a " * n, "s")], "doc_id bigint, text string, source string")
        assert sum(checked(packing.pack(some, PATH, length=4, packet=3).collect(), 4)) == n + 1

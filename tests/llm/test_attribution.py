"""Sections' tokens against whole texts encoded by the library and dealt token by token."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from tabulare.llm import attribution
from tabulare.llm.queries import LLM_JOBS

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(encoding, text, sections):
    """Per section its tokens: each token to the section with most of its bytes, the first of equal ones."""
    at = [len(text[:i].encode()) for i in range(len(text) + 1)]
    counts, place = [[0, 0] for _ in sections], 0
    for token in encoding.encode_ordinary(text):
        end = place + len(encoding.decode_single_token_bytes(token))
        held = [min(end, at[b]) - max(place, at[a]) for a, b in sections]
        if held and max(held) > 0:
            own = counts[held.index(max(held))]
            own[0] += 1
            own[1] += max(held) < end - place or any(place < at[x] < end for s in sections for x in s)
        place = end
    return [tuple(c) for c in counts]


def line_spans(text):
    cuts = [0, *(i + 1 for i, c in enumerate(text) if c == "\n"), len(text)]
    return [(a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b or not text]


def test_query_on_the_table(spark, folder, encoding):
    found = {}
    for r in LLM_JOBS["op8_token_attribution"](spark, folder).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        spans = line_spans(doc.text)
        got = sorted(found[doc.doc_id])
        assert [g[1:3] for g in got] == spans and [g[0] for g in got] == list(range(len(spans)))
        assert sum(g[3] for g in got) == len(encoding.encode_ordinary(doc.text))
        if len(doc.text) < 400:
            assert [g[3:] for g in got] == plain(encoding, doc.text, spans)


def test_any_sections_of_any_text(spark, encoding):
    made = random.Random(9)
    texts = ["".join(made.choices("ab tThe. \n\n\t12é日🙂's\x1c\x85\u3000", k=made.randrange(50))) for _ in range(300)]
    rows, expected = [], {}
    for i, text in enumerate(texts):
        cuts = sorted(made.sample(range(len(text) + 1), min(len(text) + 1, 2 * made.randrange(4))))
        spans = [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=False)]
        rows += [(i, n, a, b) for n, (a, b) in enumerate(spans)]
        expected[i] = plain(encoding, text, spans)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, section int")
    sections = spark.createDataFrame(rows, "doc_id bigint, section bigint, start bigint, end bigint")
    found = attribution.attribute_tokens(docs, PATH, public_tokenizers.PATTERN, sections).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_tokens, r.n_crossing) == expected[r.doc_id][r.section], (texts[r.doc_id], r)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a\n"), (3, "\n\n"), (3, "\n\n"), (4, "word " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = attribution.attribute_tokens(docs, PATH, public_tokenizers.PATTERN).collect()
    got = sorted(((r.doc_id or 0, r.section, r.start, r.end, r.n_tokens, r.n_crossing) for r in found))
    assert got[:3] == [(0, 0, 0, 2, 2, 0), (1, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0)]
    assert got[3:7] == [(3, 0, 0, 1, 1, 0)] * 2 + [(3, 1, 1, 2, 1, 0)] * 2 or got[3:7] == [(3, 0, 0, 1, 1, 1)] * 2 + [(3, 1, 1, 2, 0, 0)] * 2
    assert got[7][4] >= 20_000
    assert attribution.attribute_tokens(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0

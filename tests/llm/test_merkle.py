"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tabulare.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, _t string, root int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests):
    """The digest at the top, and per node below the siblings to its left and right for each step."""
    paths, held = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, under = [], []
        for start in range(0, len(digests), 16):
            run = digests[start : start + 16]
            for k in range(len(run)):
                for i in held[start + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha(*run))
            under.append([i for k in range(len(run)) for i in held[start + k]])
        digests, held = above, under
    return digests[0], paths


def expected(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for source in order:
        found = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = climb(list(map(leaf, found)))
        tops.append(top)
        inner[source] = list(zip(found, paths, strict=True))
    root, upper = climb(tops)
    out = []
    for source, top, more in zip(order, tops, upper, strict=True):
        for row, path in inner[source]:
            changed = list(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                changed[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            node = leaf(changed)
            for left, right in path + more:
                node = sha(left, node, right)
            out.append((row[0], leaf(row), top, root, sha(*(x for step in path + more for x in step)), node, node == root))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(*row, "clash", 3) for row in rows], SCHEMA).repartition(3)
    return sorted((tuple(r)[:6] + (r.verified,) for r in merkle.manifest(docs).collect()), key=str)


def made(sizes, seed=1):
    pick = random.Random(seed)
    return [
        (pick.randrange(10**6), source, pick.choice(["en", None, "dé"]), pick.choice([None, 7]), "".join(pick.choices("Ab é\n", k=pick.randrange(9))))
        for source, n in sizes
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "sizes",
    [[("a", 1)], [("a", 16)], [("a", 17), ("b", 1)], [("hot", 600), (None, 2), ("", 1), ("é", 17), ("z", 256), ("Z", 257)],
     [(f"s{i}", 1 + i % 3) for i in range(40)]],
)
def test_equals_plain_python(spark, sizes):
    rows = made(sizes)
    assert found(spark, rows) == expected(rows)


def test_odd_rows(spark):
    long = "A word " * 60_000
    rows = [(None, None, None, None, None)] * 3 + [(5, "a", "x", 1, "B")] * 20 + [(5, "a", "x", 1, "C"), (7, "a", None, None, None),
            (15, "b", "", 0, ""), (20, "b", "x", len(long), long), (-3, "b", "x", 2, "Ab")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_salted_pointers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HELD_KEYS", 2)
    monkeypatch.setattr(merkle, "FANOUT", 2)
    rows = [(i, "a", "x", 1, "t") for i in range(200)] + [(i, "b", "x", 1, "t") for i in range(9)]
    docs = spark.createDataFrame([(*row, "", 0) for row in rows], SCHEMA)
    result = merkle.manifest(docs).collect()
    assert len(result) == 209 and all(r.verified for r in result)  # nothing here is in upper case
    assert {len(r.path) for r in result} == {9, 5} and len({r.proof_sha256 for r in result}) == 209

"""Groups of near copies against all pairs of full sets on small tables."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from tabulare.llm import near
from tabulare.llm import components as components_module
from tabulare.llm.components import components
from tabulare.llm.queries import LLM_JOBS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def full_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def find(roots, i):
    while roots[i] != i:
        i = roots[i]
    return i


def brute_force(rows):
    """Component by key: every pair that shares a run of words is compared."""
    sets = [(key, full_set(text)) for key, text in rows]
    roots = {key: key for key, _ in sets}
    at = {}
    for n, (_, s) in enumerate(sets):
        for shingle in s:
            at.setdefault(shingle, []).append(n)
    for pair in {(a, b) for found in at.values() for a in found for b in found if a < b}:
        (x, s), (y, t) = sets[pair[0]], sets[pair[1]]
        if 100 * len(s & t) >= 85 * len(s | t):
            low, high = sorted((find(roots, x), find(roots, y)))
            roots[high] = low
    return {key: (len(s), find(roots, key)) for key, s in sets}


def test_query_on_the_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_force([(d.doc_id, d.text) for d in docs])
    found = LLM_JOBS["op3_minhash_near"](spark, folder).collect()
    assert len(found) == len(docs)
    for row in found:
        assert (row.n_shingles, row.component_id) == expected[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)
    assert len({c for _, c in expected.values()}) < len(docs) - 50


@pytest.mark.parametrize("block", [1_024, 16])
def test_a_large_group_and_odd_rows(spark, monkeypatch, block):
    """A group whose members are alike to different degrees; cut into blocks, it comes out the same."""
    monkeypatch.setattr(near, "BLOCK_SETS", block)
    made = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(made.randrange(5)):
            text[made.randrange(len(text))] = f"x{made.randrange(50)}"
        rows.append((i, " ".join(text)))
    rows += [(200, "a b c"), (201, "A  b\tC"), (202, "a b d"), (203, None), (204, ""), (205, " \n"), (206, "a b c d e")]
    rows += [(207, "lone " * 4000), (208, "lone " * 5000)]
    expected = brute_force(rows)
    docs = spark.createDataFrame([(k, t, "z") for k, t in rows], "doc_id bigint, text string, root string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_groups(docs).collect()}
    assert found == expected
    assert found[201] == (1, 200) and found[203] == (0, 203) and found[207] == found[208][:1] + (207,)
    assert len({c for k, (_, c) in expected.items() if k < 150}) > 3


def test_null_keys_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (1, "d e f"), (2, "d e f"), (3, "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near.near_groups(docs).collect()), key=str)
    assert found == [(1, None, False)] * 3 + [(2, None, False), (3, 3, True), (None, None, True)]
    assert near.near_groups(docs.limit(0)).count() == 0
    kept = near.keep_one_each(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == [(3, "g"), (None, "a b c")]


def test_registers_merge_and_estimate():
    made = np.random.default_rng(1)
    values = [np.unique(made.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(2)]
    union = np.unique(np.concatenate(values))
    assert (near.registers([union])[0] == np.maximum(*near.registers(values))).all()
    for similarity in (0.3, 0.6, 0.85, 0.95):
        shared = int(400 * 2 * similarity / (1 + similarity))
        hits = equal = 0
        for _ in range(200):
            a = made.integers(0, 1 << 63, 400, dtype=np.uint64)
            b = np.concatenate([a[:shared], made.integers(0, 1 << 63, 400 - shared, dtype=np.uint64)])
            x, y = near.registers([np.unique(a)]), near.registers([np.unique(b)])
            equal += (x == y).mean() / 200
            hits += near.similar_enough(x, y, np.array([400.0]), np.array([400.0]), 0.65)[0, 0]
        assert abs(equal - similarity) < 0.02
        assert hits == 200 if similarity >= 0.85 else hits < 120


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, j) for j in range(1001, 1100)] + [(5000, 4000), (7, 7)]
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    found = dict(map(tuple, components(frame).collect()))
    expected = dict.fromkeys(range(1, 301), 0) | dict.fromkeys(range(1001, 1100), 1000) | {5000: 4000}
    assert found == expected
    assert components(frame.limit(0)).count() == 0


def test_components_with_hubs(spark, monkeypatch):
    """Nodes with many links, in the middle and at the top, give the same components as plain union-find."""
    monkeypatch.setattr(components_module, "HUB_LINKS", 3)
    made = np.random.default_rng(3)
    links = [(0, i) for i in range(1, 60)] + [(500, i) for i in range(100, 160)] + [(int(a), int(b)) for a, b in made.integers(200, 330, (90, 2))]
    links += [(160, 40), (700, 699), (699, 698)]
    roots = {node: node for pair in links for node in pair}
    for a, b in links:
        low, high = sorted((find(roots, a), find(roots, b)))
        roots[high] = low
    found = dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert found == {node: find(roots, node) for node in roots if find(roots, node) != node}


def test_shared_counts_of_very_long_sets_are_exact():
    """17 of 20 parts are shared: just 85 percent, which counts in single precision miss from 2**26 hundredths on."""
    parts = next(m for m in range(39_480, 40_000) if int(np.float32(1_700 * m)) < 1_700 * m)
    hashes = np.unique(np.random.default_rng(3).integers(0, 1 << 62, 20 * parts + 1_000, np.uint64))[: 20 * parts]
    shared = 17 * parts
    values = [[hashes], [hashes[:shared]], [hashes[: shared - 1]]]
    sides = [(np.array([i]), np.array([float(len(s[0]))]), near.registers(s)) for i, s in enumerate(values, 1)]
    assert near.shared_counts(values[0], values[1]).tolist() == [[shared]]
    assert near.block_links(sides[:2], values[:2], 85) == [(1, 2)]
    assert near.block_links(sides[::2], values[::2], 85) == []


def test_registers_come_back_from_band_keys():
    made = np.random.default_rng(5)
    values = near.registers([made.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 7, 5_000)])
    assert (near.band_registers(near.band_keys(values).tolist()) == values).all()


def template_pages(pages, links):
    """Pages of 200 common words and 120 of their own, none linked; some come again with a word changed."""
    made = random.Random(4)
    common = [f"c{i}" for i in range(200)]
    texts = [" ".join([*common, *(f"p{n}x{i}" for i in range(120))]) for n in range(pages)]
    return texts + [t.replace("x60", f"y{made.randrange(9)}") for t in texts[:links]]


def test_pages_of_one_template_move_no_set(spark):
    texts = template_pages(600, 0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    sets = near.sketches(docs).withColumnRenamed("_id", "_rep")
    coarse = components(near.coarse_links(sets))
    assert coarse.count() > 500  # shared buckets tie nearly all of them
    assert near.likely_links(sets, coarse, 85).count() == 0


@pytest.mark.parametrize("limits", [(1_024, 32_000_000), (50, 32_000_000), (1_024, 40_000)])
def test_template_pages_with_copies(spark, monkeypatch, limits):
    monkeypatch.setattr(near, "BLOCK_SETS", limits[0])
    monkeypatch.setattr(near, "BLOCK_BYTES", limits[1])
    texts = template_pages(300, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    found = {r.doc_id: r.component_id for r in near.near_groups(docs).collect()}
    assert found == {i: i if i < 300 else i - 300 for i in range(360)}


def test_blocks_are_compared_in_little_memory():
    """Two full blocks of near copies, by registers and by sets; the same pairs as without strips."""
    made = np.random.default_rng(5)
    templates = made.integers(0, 1 << 62, (4, 300))
    sets = [np.unique(np.append(templates[i % 4], made.integers(0, 1 << 62, 15)).astype(np.uint64)) for i in range(2 * near.BLOCK_SETS)]
    values, sizes = near.registers(sets), np.array([len(s) for s in sets], np.float64)
    mine, theirs = slice(0, near.BLOCK_SETS), slice(near.BLOCK_SETS, None)
    tracemalloc.start()
    try:
        likely = near.similar_enough(values[mine], values[theirs], sizes[mine], sizes[theirs], 0.65)
        by_registers = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        both = near.shared_counts(sets[mine], sets[theirs])
        by_sets = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert by_registers < 24_000_000 and by_sets < 64_000_000
    assert np.array_equal(likely[700], near._similar_strip(values[700:701], values[theirs], sizes[700:701], sizes[theirs], 0.65)[0])
    assert np.array_equal(likely, np.arange(near.BLOCK_SETS)[:, None] % 4 == np.arange(near.BLOCK_SETS)[None, :] % 4)
    for i, j in ((0, 0), (700, 1_000), (1_023, 5)):
        assert both[i, j] == len(np.intersect1d(sets[i], sets[near.BLOCK_SETS + j]))

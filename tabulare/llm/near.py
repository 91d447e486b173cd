"""Near copies by mergeable register sketches: banded, estimated, and confirmed on the full sets.

A document's set holds its distinct runs of five words. A register is the
exponentially spaced, truncated minimum of an exponential variable over the
set, so the registers of a union are the larger ones of its parts, and equal
registers tell of alike sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulare.llm.components import components
from tabulare.llm.rows import id_and_bytes, let_go_by_worker, packed, slices, words
from tabulare.session import work_table

SHINGLE = 5
BANDS, ROWS = 20, 4
BASE, SCALE, TOP = 1.001, 20.0, 65_535
MARGIN = 0.2
BLOCK_SETS = 1_024
BLOCK_BYTES = 32_000_000
KNOWN_WORDS = 100_000
STRIP = 128  # sets of a block whose pairs are estimated at once
NO_ID = -(1 << 63)
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


class WordHashes(dict):
    """64-bit hashes by word; forgotten when there are too many, and computed again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; of fewer words, the one of all; of none, nothing."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(n, size)
    runs = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        runs = (runs ^ hashes[i : i + len(runs)]) * MIX[i % len(MIX)]
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def text_set(raw: bytes, known: WordHashes) -> np.ndarray:
    found = words(raw)
    return shingle_set(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))


def _register_seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(20)
    return (
        made.integers(0, 1 << 32, count, dtype=np.uint32),
        made.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
    )


def registers(sets: list[np.ndarray], count: int = BANDS * ROWS) -> np.ndarray:
    """The registers of each set that is not empty, a row per set."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    largest = np.empty((len(sets), count), np.uint32)
    for i, (flip, factor) in enumerate(zip(*_register_seeds(count), strict=True)):
        largest[:, i] = np.maximum.reduceat((low ^ flip) * factor, starts)
    smallest = -np.log((largest.astype(np.float64) + 1) / 4294967297.0) / SCALE  # of exponential variables
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per band: its registers side by side, told apart from those of other bands."""
    joined = np.ascontiguousarray(values).view(np.uint64).reshape(len(values), bands)
    return ((joined ^ np.arange(1, bands + 1, dtype=np.uint64) * MIX[1]) * MIX[0]).view(np.int64)


def band_registers(keys: list[list[int]]) -> np.ndarray:
    """The registers that band keys were made of, a row per set: a key can be turned back, so they are not kept beside it."""
    mixed = np.array(keys, np.int64).view(np.uint64) * np.uint64(pow(int(MIX[0]), -1, 1 << 64))
    bands = np.arange(1, mixed.shape[1] + 1, dtype=np.uint64) * MIX[1]
    return np.ascontiguousarray(mixed ^ bands).view(np.uint16)


def similar_enough(mine: np.ndarray, theirs: np.ndarray, sizes: np.ndarray, other: np.ndarray, cut: float) -> np.ndarray:
    """Whether the most likely similarity of each pair is ``cut`` or more, from all registers and both set sizes.

    The likelihood of how many registers are larger, smaller and equal has one
    maximum; it is at ``cut`` or above if its slope there is not negative.
    Some rows are done at a time, as each pair takes many numbers on the way.
    """
    found = np.zeros((len(mine), len(theirs)), bool)
    for start in range(0, len(mine), STRIP):
        rows = slice(start, start + STRIP)
        found[rows] = _similar_strip(mine[rows], theirs, sizes[rows], other, cut)
    return found


def _similar_strip(mine: np.ndarray, theirs: np.ndarray, sizes: np.ndarray, other: np.ndarray, cut: float) -> np.ndarray:
    larger = np.zeros((len(mine), len(theirs)), np.int16)
    smaller = np.zeros_like(larger)
    for i in range(mine.shape[1]):
        a, b = mine[:, i, None], theirs[None, :, i]
        larger += a > b
        smaller += a < b
    equal = mine.shape[1] - larger - smaller
    u = sizes[:, None] / (sizes[:, None] + other[None, :])
    v = 1 - u
    x, y = np.maximum(u - v * cut, 1e-12), np.maximum(v - u * cut, 1e-12)
    ratio, log_base = (BASE - 1) / BASE, np.log(BASE)
    p, q = -np.log1p(-x * ratio) / log_base, -np.log1p(-y * ratio) / log_base
    p_slope, q_slope = ratio / (1 - x * ratio) / log_base, ratio / (1 - y * ratio) / log_base
    slope = -larger * v * p_slope / p - smaller * u * q_slope / q
    slope += equal * (v * p_slope + u * q_slope) / np.maximum(1 - p - q, 1e-12)
    return (slope >= 0) & (np.minimum(u, v) >= cut * np.maximum(u, v))


def shared_counts(mine: list[np.ndarray], theirs: list[np.ndarray], columns: int = 2_048) -> np.ndarray:
    """The exact size of every intersection, by products of 0/1 matrices over some columns at a time, summed as integers."""
    every, place = np.unique(np.concatenate([*mine, *theirs]), return_inverse=True)
    row = np.repeat(np.arange(len(mine) + len(theirs)), [len(s) for s in [*mine, *theirs]])
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    total = np.zeros((len(mine), len(theirs)), np.int64)
    for start in range(0, len(every), columns):
        low, high = np.searchsorted(place, [start, start + columns])
        held = np.zeros((len(mine) + len(theirs), columns), np.float32)
        held[row[low:high], place[low:high] - start] = 1
        total += (held[: len(mine)] @ held[len(mine) :].T).astype(np.int64)
        del held  # before the next one is made
    return total


def spanning_links(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the links set in a matrix, as many as hold its groups together: one walk for each group."""
    found, waiting = [], set(range(len(left)))
    seen_right = np.zeros(len(right), bool)
    while waiting:
        todo = [waiting.pop()]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(linked[i] & ~seen_right):
                seen_right[j] = True
                found.append((int(left[i]), int(right[j])))
                for k in np.flatnonzero(linked[:, j]):
                    if int(k) in waiting:
                        waiting.remove(int(k))
                        todo.append(int(k))
                        found.append((int(left[k]), int(right[j])))
    return [pair for pair in found if pair[0] != pair[1]]


Side = tuple[np.ndarray, np.ndarray, np.ndarray]


def likely_matrix(mine: Side, theirs: Side, percent: int) -> np.ndarray:
    """Which pairs of two blocks of (ids, set sizes, registers) may be linked, as their registers tell."""
    return similar_enough(mine[2], theirs[2], mine[1], theirs[1], percent / 100 - MARGIN)


def block_links(sides: list[Side], values: list[list[np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links that hold together what is linked within a block, or between two: pairs estimated first, confirmed on full sets."""
    mine, theirs = sides
    likely = likely_matrix(mine, theirs, percent)
    if not likely.any():
        return []
    both = shared_counts(*values)
    linked = likely & (100 * both >= percent * (mine[1][:, None] + theirs[1][None, :] - both))
    return spanning_links(linked, mine[0], theirs[0])


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``_id``, ``_n`` (size of its set), ``_set`` (a digest of the set) and ``_bands``, its band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_by_worker("encoder")  # the worker may have encoded before
        known = WordHashes()
        for part in slices(batches):
            sets = [text_set(raw.as_py(), known) for raw in part.column("_text")]
            filled = [s for s in sets if len(s)]
            keys = iter(band_keys(registers(filled)).tolist()) if filled else iter(())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                names=["_id", "_n", "_set", "_bands"],
            )

    narrow = id_and_bytes(docs, key, text).withColumn("_id", F.coalesce("_id", F.lit(NO_ID)))
    return narrow.mapInArrow(sketch, "_id bigint, _n bigint, _set binary, _bands array<bigint>")


def coarse_links(sets: DataFrame) -> DataFrame:
    """Each document of a band bucket tied to the smallest one in it: a bucket of any size gives a link per document."""
    keyed = sets.select(F.col("_rep").alias("v"), F.explode("_bands").alias("_band"))
    hubs = keyed.groupBy(F.col("_band").alias("_b")).agg(F.min("v").alias("u"), F.count("*").alias("_rows")).where("_rows > 1")
    return keyed.join(hubs, F.col("_band") == F.col("_b")).where("u != v").select("u", "v").distinct()


def placed_members(sets: DataFrame, clusters: DataFrame, row_bytes: Column) -> DataFrame:
    """The sets of each cluster, dealt by a hash to blocks of about ``BLOCK_SETS`` sets and ``BLOCK_BYTES`` of ``row_bytes``.

    Only a single set can make a block much larger than that.
    """
    roots = clusters.select("root").distinct().select(F.col("root").alias("node"), "root")
    members = clusters.unionByName(roots).join(sets, F.col("node") == F.col("_rep"))
    members = members.select("node", "root", "_n", "_bands", F.col("_set").alias("_wanted"))
    sizes = members.groupBy(F.col("root").alias("_root")).agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(row_bytes) / BLOCK_BYTES)
        ).cast("int").alias("_blocks")
    )
    placed = members.join(sizes, F.col("root") == F.col("_root")).drop("_root")
    return placed.withColumn("_block", F.pmod(F.xxhash64("node", "_wanted"), F.col("_blocks")).cast("int"))


def meeting_blocks(placed: DataFrame) -> DataFrame:
    """Each set once for every block of its cluster: ``_low`` and ``_high`` name the two blocks that meet."""
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return placed.withColumn("_other", other).select(
        *(name for name in placed.columns if name != "_blocks"),
        F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"),
    )


def _sides(table: pa.Table) -> tuple[list[Side], list[np.ndarray]]:
    """The two blocks of a group, and the rows that each of them takes."""
    ids = np.array(table.column("node").to_pylist(), np.int64)
    sizes = np.array(table.column("_n").to_pylist(), np.float64)
    keys = table.column("_bands").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    values = band_registers(keys.reshape(len(ids), -1))
    block = np.array(table.column("_block").to_pylist())
    rows = [np.flatnonzero(block == table.column(name)[0].as_py()) for name in ("_low", "_high")]
    return [(ids[at], sizes[at], values[at]) for at in rows], rows


def _pairs(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def likely_links(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links that hold together the sets of a cluster that may be linked, by their registers alone.

    No text is read and no set is moved: a row is its registers, 160 bytes.
    """

    def link(table: pa.Table) -> pa.Table:
        sides, _ = _sides(table)
        if table.num_rows < 2 or not all(len(ids) for ids, *_ in sides):
            return _pairs([])
        return _pairs(spanning_links(likely_matrix(*sides, percent), sides[0][0], sides[1][0]))

    placed = placed_members(sets, clusters, F.lit(8) * F.size("_bands")).drop("_wanted")
    return meeting_blocks(placed).groupBy("root", "_low", "_high").applyInArrow(link, "u bigint, v bigint")


def confirmed_links(
    docs: DataFrame, sets: DataFrame, clusters: DataFrame, percent: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Links between documents of one cluster whose full sets are alike.

    Every two blocks of a cluster meet in one task, which reads their sets only.
    """
    placed = work_table(placed_members(sets, clusters, F.col("_n") * 8), "placed")
    moved = ("node", "root", "_n", "_bands", "_blocks", "_block")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            found = [text_set(raw.as_py(), known).tobytes() for raw in part.column("_text")]
            wanted = part.column("_wanted").to_pylist()
            # Rows that share a key with another text are not the ones looked for.
            same = [hashlib.blake2b(s, digest_size=16).digest() == w for s, w in zip(found, wanted, strict=True)]
            kept = pa.array(same, pa.bool_())
            columns = [part.column(name).filter(kept) for name in moved]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary()).filter(kept)], names=[*moved, "_values"])

    narrow = id_and_bytes(docs, key, text).withColumn("_id", F.coalesce("_id", F.lit(NO_ID)))
    # The same join at every size: the list grows with the documents.
    texts = narrow.join(placed.hint("merge"), F.col("_id") == F.col("node")).select("_text", "_wanted", *moved)
    full = texts.mapInArrow(
        build, "node bigint, root bigint, _n bigint, _bands array<bigint>, _blocks int, _block int, _values binary"
    )

    def link(table: pa.Table) -> pa.Table:
        sides, rows = _sides(table)
        if table.num_rows < 2 or not all(len(at) for at in rows):
            return _pairs([])
        values = [np.frombuffer(raw.as_buffer(), np.uint64) for raw in table.column("_values")]
        return _pairs(block_links(sides, [[values[i] for i in at] for at in rows], percent))

    return meeting_blocks(full).groupBy("root", "_low", "_high").applyInArrow(link, "u bigint, v bigint")


def near_groups(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked if ``100 * shared >= percent * all`` of their
    runs of five words. The component is the smallest key reachable by links,
    its own included; that document is kept. A null or empty text has an empty
    set and is linked with nothing; a null key is smaller than any other and
    comes out as null; rows with the same key share their component and are
    kept or dropped together; an empty table gives no rows.

    Equal sets are one before anything else is done. The probability that a
    link is overlooked because no band has the two sets in one bucket is
    (1 - J ** ROWS) ** BANDS, below 1e-6 at a similarity J of 0.85.
    """
    sketched = work_table(sketches(docs, key, text), "sketches")
    filled = sketched.where("_n > 0")
    equal = filled.groupBy("_set").agg(
        F.min("_id").alias("_rep"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands")
    )
    sets = work_table(equal, "sets")
    # Buckets tie whatever meets in one; registers then part what only shares a template, before any full set moves.
    clusters = components(likely_links(sets, components(coarse_links(sets)), percent))
    # A representative may stand for two sets, when rows with one key differ; its links hold for the key.
    links = components(confirmed_links(docs, sets, clusters, percent, key, text).unionByName(_same_key(filled)))
    of_set = sets.join(links, F.col("_rep") == F.col("node"), "left").select(
        F.col("_set").alias("_s"), F.coalesce("root", "_rep").alias("_component")
    )
    of_set = work_table(of_set, "components")
    component = F.coalesce("_component", "_id")
    return sketched.join(of_set, F.col("_set") == F.col("_s"), "left").select(
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.when(component != NO_ID, component).alias("component_id"),
        (F.col("_id") == component).alias("kept"),
    )


def _same_key(filled: DataFrame) -> DataFrame:
    """Ties sets whose representatives differ though rows with one key have them."""
    of_set = filled.groupBy("_set").agg(F.min("_id").alias("_rep"))
    several = filled.groupBy(F.col("_id").alias("_k")).agg(
        F.min("_set").alias("_first"), F.max("_set").alias("_last")
    ).where(F.col("_first") != F.col("_last"))
    rows = filled.join(several, F.col("_id") == F.col("_k")).select("_id", "_set")
    return rows.join(of_set, "_set").select(F.col("_id").alias("u"), F.col("_rep").alias("v"))


def keep_one_each(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of each group that is kept, with the columns it came with; rows with one key stay or go together.

    Texts that are null or empty, or have no words, are near copies of nothing
    and all stay; a null key is the smallest of its group, so that it stays;
    whole texts of any length are compared; an empty table stays empty, and
    columns of any name or type are carried along.
    """
    found = near_groups(docs, percent, key, text).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = packed(docs, _id=key).withColumn("_id", F.col("_id").cast("bigint"))
    return rows.join(found.hint("merge"), F.col("_id").eqNullSafe(F.col("_kept")), "left_semi").select("_row.*")

"""Removal of long byte strings that occur more than once in a corpus, by suffix arrays of shards.

Anchors, picked from the content of each window of a string's length, bring
together the places that may hold the same string. The bytes around them go to
shards, such that all places of a string are in one; a shard's suffix array
tells exactly which strings occur again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulare.llm.rows import id_and_bytes, slices
from tabulare.llm.suffix import repeated_starts
from tabulare.session import work_table

LENGTH = 400
GRAM_BITS = 7  # anchors are strings of 128 bytes
SHARD_BYTES = 1_000_000
MOST_BYTES = 4_000_000
PIECE = 1 << 22
NO_ID = -(1 << 63)
PLACE_BITS = 32
BYTE_HASH = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64)
FACTORS = [np.uint64(2 * int(f) + 1) for f in np.random.default_rng(128).integers(1 << 40, 1 << 62, 16)]


def gram_hashes(data: np.ndarray, bits: int = GRAM_BITS) -> np.ndarray:
    """A hash of the ``2 ** bits`` bytes from each position on, each round joining two of half the length."""
    values = BYTE_HASH[data]
    for i in range(bits):
        width = 1 << i
        values = (values[:-width] * FACTORS[i]) ^ (values[width:] + FACTORS[-1 - i])
        values ^= values >> np.uint64(31)
    return values


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def anchors(raw: bytes, length: int = LENGTH, bits: int = GRAM_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes, so that every ``length`` bytes hold an anchor with the smallest hash of all their grams.

    Equal strings therefore have an anchor of the same hash. Of the equal
    hashes in a string that repeats itself only as many are kept as are needed;
    one that stands for others too is marked, as two equal strings may share it.
    """
    data = np.frombuffer(raw, np.uint8)
    width = length - (1 << bits) + 1
    kept_at, kept_hash, kept_tied = [], [], []
    for start in range(0, max(len(data) - length + 1, 0), PIECE):
        hashes = gram_hashes(data[start : start + PIECE + length - 1], bits)
        place = np.arange(len(hashes), dtype=np.uint64)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        ranked = (hashes & ~mask) | (mask - place)  # of equal ones the last
        least = (mask - (sliding_least(ranked, width) & mask)).astype(np.int64)
        first = np.flatnonzero(np.diff(least, prepend=-1))
        last = np.append(first[1:], len(least)) - 1
        at, value, held = least[first], hashes[least[first]], -1
        chosen, tied = [], np.zeros(len(at), bool)
        for i, (position, until, gram) in enumerate(zip(at.tolist(), last.tolist(), value.tolist(), strict=True)):
            if held < 0 or gram != value[held] or until > at[held]:
                chosen.append(i)
                held = i
            else:
                tied[held] = True
        kept_at.append(at[chosen] + start)
        kept_hash.append(value[chosen])
        kept_tied.append(tied[chosen])
    if not kept_at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    every = np.concatenate(kept_at)
    at, index, place = np.unique(every, return_index=True, return_inverse=True)
    marked = np.bincount(place, np.concatenate(kept_tied), len(at)) > 0
    return at, np.concatenate(kept_hash)[index], marked


def bounds(at: int, size: int, length: int, gram: int) -> tuple[int, int]:
    """The bytes that all strings of ``length`` around an anchor can reach."""
    return max(0, at + gram - length), min(size, at + length)


def keyed_bytes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_id``, ``_text`` and ``_x``, a hash of the text: rows that share a key are told apart by it."""
    rows = id_and_bytes(docs, key, text).withColumn("_id", F.coalesce("_id", F.lit(NO_ID)))
    return rows.withColumn("_x", F.xxhash64("_text"))


def anchor_rows(rows: DataFrame, length: int, bits: int) -> DataFrame:
    """A row per anchor: its place (``_id``, ``_x``, ``_at``), its hash ``_h``, a hash ``_c`` of all around it, the bounds, and ``_tied``."""
    gram, names = 1 << bits, ["_id", "_x", "_at", "_h", "_c", "_low", "_high", "_tied"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            columns: list[list] = [[] for _ in range(8)]
            for key, mark, raw in zip(*(part.column(n).to_pylist() for n in ("_id", "_x", "_text")), strict=True):
                for at, value, tied in zip(*(a.tolist() for a in anchors(raw, length, bits)), strict=True):
                    low, high = bounds(at, len(raw), length, gram)
                    around = xxhash.xxh3_64_intdigest(raw[low:high], seed=at - low)
                    row = (key, mark, at, value - (1 << 63), around - (1 << 63), low, high, int(tied))
                    for column, field in zip(columns, row, strict=True):
                        column.append(field)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=names
            )

    schema = ", ".join(f"{n} bigint" for n in names)
    return rows.select("_id", "_x", "_text").mapInArrow(find, schema)


def _labelled(needed: DataFrame) -> DataFrame:
    """``needed`` with ``_label``: places that share anchors get the same one where that does not gather too much.

    A document takes the smallest hash of its anchors, an anchor the smallest
    label of its documents: the copies of a text tend to meet in one label, so
    that the bytes around neighbouring anchors need not be repeated. A label
    that gathers too much is given up for the anchors' own.
    """
    of_document = needed.groupBy(F.col("_id").alias("_i"), F.col("_x").alias("_y")).agg(F.min("_h").alias("_least"))
    named = needed.join(of_document, (F.col("_id") == F.col("_i")) & (F.col("_x") == F.col("_y"))).drop("_i", "_y")
    of_anchor = named.groupBy(F.col("_h").alias("_g")).agg(F.min("_least").alias("_label"))
    labelled = work_table(
        named.drop("_least").join(of_anchor, F.col("_h") == F.col("_g")).drop("_g"), "labelled"
    )
    gathered = labelled.groupBy(F.col("_label").alias("_l")).agg(F.sum(F.col("_high") - F.col("_low")).alias("_bytes"))
    heavy = work_table(gathered.where(F.col("_bytes") > 2 * MOST_BYTES).select("_l"), "heavy")
    own = F.when(F.col("_l").isNull(), F.col("_label")).otherwise(F.col("_h"))
    return labelled.join(heavy, F.col("_label") == F.col("_l"), "left").withColumn("_label", own).drop("_l")


def _hot_intervals(rows: DataFrame, hot: DataFrame, length: int) -> DataFrame:
    """For places of anchors that are too many for one task: every string around them is counted by its digest.

    Only counts by digest are shuffled, summed in the tasks first, so that no
    task holds the places of an anchor.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, marks, starts, digests = [], [], [], []
            for key, mark, spans, raw in zip(
                *(part.column(n).to_pylist() for n in ("_id", "_x", "_spans", "_text")), strict=True
            ):
                wanted = {s for span in spans for s in range(span["_low"], span["_high"] - length + 1)}
                for start in sorted(wanted):
                    ids.append(key)
                    marks.append(mark)
                    starts.append(start)
                    digests.append(hashlib.blake2b(raw[start : start + length], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(starts, pa.int64()), pa.array(digests, pa.binary())],
                names=["_id", "_x", "_start", "_digest"],
            )

    spans = hot.groupBy(F.col("_id").alias("_i"), F.col("_x").alias("_y")).agg(
        F.collect_list(F.struct("_low", "_high")).alias("_spans")
    )
    strings = work_table(
        rows.join(spans.hint("merge"), (F.col("_id") == F.col("_i")) & (F.col("_x") == F.col("_y")))
        .select("_id", "_x", "_spans", "_text")
        .mapInArrow(cut, "_id bigint, _x bigint, _start bigint, _digest binary"),
        "strings",
    )
    place = F.struct("_id", "_x", "_start")
    again = (
        strings.groupBy(F.col("_digest").alias("_d"))
        .agg(F.min(place).alias("_a"), F.max(place).alias("_b"))
        .where(F.col("_a") != F.col("_b"))
        .select("_d")
    )
    return strings.join(again, F.col("_digest") == F.col("_d")).select(
        "_id", "_x", F.col("_start").alias("_from"), (F.col("_start") + length).alias("_to")
    )


def _shard_intervals(rows: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """Covered stretches found by the suffix arrays of shards; a shard holds whole labels."""
    total = needed.agg(F.sum(F.col("_high") - F.col("_low"))).first()[0] or 0
    shards = 1 + total // SHARD_BYTES
    spans = needed.groupBy(F.col("_id").alias("_i"), F.col("_x").alias("_y")).agg(
        F.collect_list(
            F.struct(F.pmod(F.xxhash64("_label"), F.lit(shards)).alias("_shard"), "_low", "_high")
        ).alias("_spans")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            columns: list[list] = [[] for _ in range(5)]
            for key, mark, spans, raw in zip(
                *(part.column(n).to_pylist() for n in ("_id", "_x", "_spans", "_text")), strict=True
            ):
                by_shard: dict[int, list] = {}
                for span in sorted(spans, key=lambda s: (s["_shard"], s["_low"])):
                    held = by_shard.setdefault(span["_shard"], [])
                    if held and span["_low"] <= held[-1][1]:
                        held[-1][1] = max(held[-1][1], span["_high"])
                    else:
                        held.append([span["_low"], span["_high"]])
                for shard, held in by_shard.items():
                    for low, high in held:
                        for column, value in zip(columns, (shard, key, mark, low, raw[low:high]), strict=True):
                            column.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["_shard", "_id", "_x", "_low", "_bytes"],
            )

    segments = (
        rows.join(spans.hint("merge"), (F.col("_id") == F.col("_i")) & (F.col("_x") == F.col("_y")))
        .select("_id", "_x", "_spans", "_text")
        .mapInArrow(cut, "_shard bigint, _id bigint, _x bigint, _low bigint, _bytes binary")
    )

    def search(table: pa.Table) -> pa.Table:
        places = list(zip(*(table.column(n).to_pylist() for n in ("_id", "_x", "_low")), strict=True))
        first: dict[tuple, int] = {}
        for i, place in enumerate(places):  # rows with the same key and text are one place
            first.setdefault(place, i)
        chosen = sorted(first.values())
        texts = table.column("_bytes").to_pylist()
        n = len(chosen)
        # Between texts stands a symbol that occurs once: no string reaches over it.
        joined = np.concatenate(
            [np.append(np.frombuffer(texts[i], np.uint8).astype(np.int32) + n, k) for k, i in enumerate(chosen)]
        )
        starts = np.flatnonzero(repeated_starts(joined, length))
        sizes = np.array([len(texts[i]) + 1 for i in chosen])
        offset = np.cumsum(sizes) - sizes
        of = np.searchsorted(offset, starts, "right") - 1
        breaks = np.flatnonzero((np.diff(starts) > length) | (np.diff(of) != 0)) + 1
        found: list[list] = [[], [], [], []]
        for run in np.split(np.arange(len(starts)), breaks) if len(starts) else []:
            key, mark, low = places[chosen[of[run[0]]]]
            begin = low + int(starts[run[0]] - offset[of[run[0]]])
            stop = low + int(starts[run[-1]] - offset[of[run[0]]]) + length
            for column, value in zip(found, (key, mark, begin, stop), strict=True):
                column.append(value)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], names=["_id", "_x", "_from", "_to"])

    return segments.groupBy("_shard").applyInArrow(search, "_id bigint, _x bigint, _from bigint, _to bigint")


def repeated_intervals(rows: DataFrame, length: int = LENGTH, bits: int = GRAM_BITS) -> DataFrame:
    """``_id``, ``_x``, ``_from``, ``_to``: stretches whose bytes are covered by strings that occur again."""
    found = work_table(anchor_rows(rows, length, bits), "anchors")
    place = F.struct("_id", "_x", "_at")
    # The same bytes around the same anchor at two places: all strings in them occur again.
    around = work_table(
        found.groupBy("_h", "_c").agg(
            F.min(F.struct("_id", "_x", "_at", "_low", "_high")).alias("_one"), F.max(place).alias("_last"),
            F.max("_tied").alias("_tied"),
        ).select("_h", "_c", "_one.*", "_tied", ((F.col("_one._id") != F.col("_last._id")) | (F.col("_one._x") != F.col("_last._x"))
                                        | (F.col("_one._at") != F.col("_last._at"))).alias("_several")),
        "around",
    )
    several = around.where("_several").select(F.col("_h").alias("_g"), F.col("_c").alias("_d"))
    same = found.join(several, (F.col("_h") == F.col("_g")) & (F.col("_c") == F.col("_d"))).select(
        "_id", "_x", F.col("_low").alias("_from"), F.col("_high").alias("_to")
    )
    # Different bytes around anchors of one hash, or a string that repeats itself: one place of each is searched.
    differing = around.groupBy(F.col("_h").alias("_g")).agg(
        F.count("*").alias("_kinds"), F.sum(F.col("_high") - F.col("_low")).alias("_bytes"),
        F.max("_tied").alias("_any"),
    ).where((F.col("_kinds") > 1) | (F.col("_any") > 0))
    needed = work_table(
        around.join(differing, F.col("_h") == F.col("_g")).select("_id", "_x", "_at", "_h", "_low", "_high", "_bytes"),
        "needed",
    )
    hot = needed.where(F.col("_bytes") > MOST_BYTES)
    cool = needed.where(F.col("_bytes") <= MOST_BYTES)
    intervals = [same, _shard_intervals(rows, work_table(_labelled(cool), "labels"), length)]
    if not hot.isEmpty():
        intervals.append(_hot_intervals(rows, hot, length))
    # Rows with the same key and text are one place above, and yet two.
    repeated = rows.groupBy("_id", "_x").agg(F.count("*").alias("_rows"), F.max(F.octet_length("_text")).alias("_size"))
    intervals.append(
        repeated.where((F.col("_rows") > 1) & (F.col("_size") >= length)).select(
            "_id", "_x", F.lit(0).cast("bigint").alias("_from"), F.col("_size").cast("bigint").alias("_to")
        )
    )
    everything = intervals[0]
    for more in intervals[1:]:
        everything = everything.unionByName(more)
    return everything


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, bits: int = GRAM_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``spans`` (removed stretches, start and end) and ``kept``, the bytes that remain.

    A byte goes if it is covered by a string of ``length`` bytes that also
    starts anywhere else, in the same text too; overlapping ones count. Null
    and short texts keep all; rows with the same key and text are two places;
    an empty table gives no rows.
    """
    rows = keyed_bytes(docs, key, text)
    spans = work_table(
        repeated_intervals(rows, length, bits)
        .groupBy(F.col("_id").alias("_i"), F.col("_x").alias("_y"))
        .agg(F.sort_array(F.collect_set(F.struct("_from", "_to"))).alias("_spans")),
        "spans",
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            merged, kept = [], []
            for spans, raw in zip(part.column("_spans").to_pylist(), part.column("_text").to_pylist(), strict=True):
                runs: list[list[int]] = []
                for span in spans or []:
                    if runs and span["_from"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span["_to"])
                    else:
                        runs.append([span["_from"], span["_to"]])
                ends = [0, *(edge for run in runs for edge in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                merged.append([{"start": a, "end": b} for a, b in runs])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            sizes = pc.binary_length(part.column("_text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), sizes, pa.array(merged, kind), pa.array(kept, pa.binary())],
                names=["_id", "n_bytes", "spans", "kept"],
            )

    schema = "_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return (
        rows.join(spans.hint("merge"), (F.col("_id") == F.col("_i")) & (F.col("_x") == F.col("_y")), "left")
        .select("_id", "_spans", "_text")
        .mapInArrow(remove, schema)
        .select(F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), "n_bytes", "spans", "kept")
    )

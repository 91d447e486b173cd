"""Packing token ids into sequences by deficit round-robin over source queues, so that windows follow target shares.

Each round gives a source a quantum of tokens in proportion to its target. A
source serves the packets at the head of its queue while they fit into what it
was given and has not used; the rest is its deficit, carried to the next round.
So through round r a source serves just the packets that end within (r + 1)
quanta of its queue: a packet's round follows from where it ends, and no task
needs to see the rounds before. The served packets, round by round and source
by source, are one stream of tokens, which is cut into sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulare.llm.bpe import _read, shared_encoder
from tabulare.llm.rows import let_go_by_worker, slices
from tabulare.session import work_table

LENGTH = 2_048
PACKET = 512
END_ID = 1
CELLS = 4_096
SHARES = 1 << 40  # a target share is a whole number of these parts


def encoded_rows(docs: DataFrame, vocabulary: str, end_id: int, key: str, text: str, source: str) -> DataFrame:
    """Per row: ``_row`` (a number of its own), ``_id``, ``_src``, ``_n`` (tokens, the end too) and ``_ids``, 16 or 32 bits each."""
    given = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).cast("bigint").alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("_src"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(given.value, None)
        wide = max(end_id, len(encoder.model.tokens)) >= 1 << 16
        end = np.array([end_id], np.int32).tobytes()
        for part in slices(batches):
            encoded, _ = encoder.encode([str(raw.as_buffer(), "utf-8") for raw in part.column("_text")])
            sizes = np.array([len(ids) // 4 + 1 for ids in encoded], np.int64)
            flat = np.frombuffer(b"".join(x for ids in encoded for x in (ids, end)), np.int32)
            data = flat.astype("<u4" if wide else "<u2").tobytes()
            offsets = np.concatenate([[0], np.cumsum(sizes)]) * (4 if wide else 2)
            ids = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), part.column("_id"), part.column("_src"), pa.array(sizes), ids],
                names=["_row", "_id", "_src", "_n", "_ids"],
            )

    return rows.mapInArrow(encode, "_row bigint, _id bigint, _src string, _n bigint, _ids binary")


def target_shares(sizes: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Per source ``_share``: its target in parts of ``SHARES`` for each window, from weights or from its own tokens.

    A source without a weight, or with none above 0, gets the smallest one.
    """
    if weights is not None:
        given = weights.groupBy(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_of")).agg(
            F.max(F.col("weight").cast("double")).alias("_given")
        )
        sizes = sizes.join(given, F.col("_src") == F.col("_of"), "left").select(
            "_src", F.when(F.col("_given") > 0, F.col("_given")).alias("_tokens")
        )
    total = sizes.agg(F.sum("_tokens").alias("all"), F.min("_tokens").alias("least")).first()
    whole, least = float(total["all"] or 1), float(total["least"] or 1)
    share = F.coalesce(F.col("_tokens").cast("double"), F.lit(least)) / whole * SHARES
    return sizes.select("_src", F.greatest(F.floor(share).cast("bigint"), F.lit(1).cast("bigint")).alias("_share"))


def call_div(over: Column, under: Column) -> Column:
    """The whole part of a quotient of whole numbers, exact where a division of decimals would round."""
    return F.call_function("div", over, under.cast("decimal(20,0)"))


def cumulated(rows: DataFrame, group: list[str], cell: str, order: list[str], amount: str, name: str) -> DataFrame:
    """``rows``, a written table, with the sum of ``amount`` over all rows before, by group, cell and order within a cell."""
    cells = rows.groupBy(*group, cell).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = work_table(
        cells.select(*(F.col(c).alias(f"{c}_o") for c in (*group, cell)), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")),
        "offsets",
    )
    same = [F.col(c) == F.col(f"{c}_o") for c in (*group, cell)]
    inside = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return (
        rows.withColumn("_inside", summed)
        .join(offsets, same)
        .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("bigint"))
        .drop(*(f"{c}_o" for c in (*group, cell)), "_offset", "_inside")
    )


def packets(rows: DataFrame, weights: DataFrame | None, length: int, packet: int, cells: int) -> DataFrame:
    """Per packet of a row: ``_row``, ``_first`` and ``_size`` (its tokens), and ``_at``, its place in the stream of all."""
    sizes = work_table(rows.groupBy("_src").agg(F.sum("_n").alias("_tokens")), "sizes")
    shares = work_table(target_shares(sizes, weights), "shares")
    place = F.xxhash64("_id", "_row")  # rows that share a key are spread too
    queued = cumulated(
        work_table(rows.select("_row", "_src", "_n", place.alias("_hash"), F.pmod(place, F.lit(cells)).cast("int").alias("_cell")), "queues"),
        ["_src"], "_cell", ["_hash", "_row"], "_n", "_start",
    )
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(packet).cast("bigint")))
    cut = queued.select("_row", "_src", "_start", "_n", first.alias("_first")).withColumn(
        "_size", F.least(F.lit(packet).cast("bigint"), F.col("_n") - F.col("_first"))
    )
    # The last token of the packet, counted in the source's queue, is served within (round + 1) * length * share / SHARES.
    last = F.col("_start") + F.col("_first") + F.col("_size")
    quantum = F.col("_share") * length
    served = call_div(last.cast("decimal(20,0)") * F.lit(SHARES).cast("decimal(13,0)") + quantum - 1, quantum) - 1
    served_in = cut.join(shares.withColumnRenamed("_src", "_s"), F.col("_src") == F.col("_s")).select(
        "_row", "_src", "_first", "_size", (F.col("_start") + F.col("_first")).alias("_order"), served.alias("_round")
    )
    served_in = work_table(served_in, "served")
    rounds = (served_in.agg(F.max("_round")).first()[0] or 0) + 1
    width = -(-rounds // cells)
    celled = served_in.withColumn("_cell", F.floor(F.col("_round") / width).cast("int"))
    return cumulated(celled, [], "_cell", ["_round", "_src", "_order", "_row"], "_size", "_at").select("_row", "_first", "_size", "_at")


def with_sequences(cut: DataFrame, total: int, length: int) -> DataFrame:
    """Per row the list ``_pieces`` of (start, length, sequence, offset), neighbours in one sequence put together.

    Sequences have ``length`` tokens each. What is left at the end goes to one
    sequence for each power of two in its number of tokens, largest first, so
    nothing is padded.
    """
    full, rest = divmod(total, length)
    tails, at = [], full * length
    for power in reversed(range(length.bit_length())):
        if rest >> power & 1:
            tails.append((at, full + len(tails)))
            at += 1 << power
    number = F.floor(F.col("_p") / length)
    begin = number * length
    for low, sequence in tails:
        number = F.when(F.col("_p") >= low, F.lit(sequence)).otherwise(number)
        begin = F.when(F.col("_p") >= low, F.lit(low)).otherwise(begin)
    # A packet is cut where a sequence begins: at most once for each full one and each tail that it reaches.
    inner = F.sequence(F.floor(F.col("_at") / length) + 1, F.floor((F.col("_at") + F.col("_size") - 1) / length))
    inner = F.transform(F.when(F.col("_at") % length + F.col("_size") > length, inner).otherwise(F.array().cast("array<bigint>")), lambda s: s * length)
    edges = F.array_sort(F.array_distinct(F.concat(F.array("_at"), inner, *(
        [F.filter(F.array(*(F.lit(low).cast("bigint") for low, _ in tails)), lambda e: (e > F.col("_at")) & (e < F.col("_at") + F.col("_size")))] if tails else []
    ))))
    parts = (
        cut.withColumn("_edges", edges)
        .select("_row", "_first", "_size", "_at", "_edges", F.posexplode("_edges").alias("_k", "_p"))
        .withColumn("_end", F.coalesce(F.get("_edges", F.col("_k") + 1), F.col("_at") + F.col("_size")))
        .select(
            "_row", (F.col("_first") + F.col("_p") - F.col("_at")).alias("start"), (F.col("_end") - F.col("_p")).alias("length"),
            number.cast("bigint").alias("sequence"), (F.col("_p") - begin).cast("bigint").alias("offset"),
        )
    )
    piece = F.struct("start", "length", "sequence", "offset")
    return parts.groupBy(F.col("_row").alias("_r")).agg(F.sort_array(F.collect_list(piece)).alias("_pieces"))


def pack(
    docs: DataFrame,
    vocabulary: str,
    weights: DataFrame | None = None,
    length: int = LENGTH,
    packet: int = PACKET,
    end_id: int = END_ID,
    cells: int = CELLS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and its ``ids``, 32 bits each.

    Each document's ids, and ``end_id``, lie in one or more pieces; a sequence
    has ``length`` ids, the last ones fewer, a power of two each, so that no
    sequence is padded. While no source is used up, after every round each
    source has had its target tokens, less a deficit of under a packet; after
    every window, within a packet and its share of all sources' deficits. Targets are ``weights`` (``source``,
    ``weight``), or the sources' own tokens, which let all last to the end.
    When a source is used up, the others share the windows in their proportions.

    A null or empty text has the end only; a null source is a source like
    another; repeated rows and null keys are documents of their own; a source
    without a weight gets the smallest; one given twice gets the larger; an
    empty table gives no rows. Documents queue in the order of a hash of their
    key. Texts are encoded once. Running sums are taken per cell, ``cells`` of
    them for each source and for all rounds, so no task holds a source.
    """
    rows = work_table(encoded_rows(docs, vocabulary, end_id, key, text, source), "encoded")
    total = rows.agg(F.sum("_n")).first()[0] or 0
    pieces = with_sequences(packets(rows, weights, length, packet, cells), total, length)

    def slice_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_by_worker("encoder")
        for part in slices(batches, "_ids"):
            found: list[list] = [[] for _ in range(7)]
            columns = (part.column(name).to_pylist() for name in ("_id", "_n", "_pieces"))
            for raw, key_, n, own in zip(part.column("_ids"), *columns, strict=True):
                buffer = raw.as_buffer()
                ids = np.frombuffer(buffer, "<u2" if len(buffer) == 2 * n else "<u4").astype("<u4")
                held: list[list[int]] = []
                for p in own:
                    if held and held[-1][2] == p["sequence"] and held[-1][3] + held[-1][1] == p["offset"]:
                        held[-1][1] += p["length"]
                    else:
                        held.append([p["start"], p["length"], p["sequence"], p["offset"]])
                for start, size, sequence, offset in held:
                    row = (key_, start, size, n, sequence, offset, ids[start : start + size].tobytes())
                    for column, value in zip(found, row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=schema.names)

    schema = T.StructType.fromDDL(
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
    together = rows.join(pieces.hint("merge"), F.col("_row") == F.col("_r")).select("_id", "_n", "_ids", "_pieces")
    return together.mapInArrow(slice_ids, schema)

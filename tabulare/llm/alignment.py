"""Alignment of two tokenizers over a corpus: byte groups, linked pairs of ids, and in how many documents a pair is linked.

A text is cut before blanks that follow other than white space; no token of
either tokenizer crosses such a place, so the parts are encoded and aligned on
their own, each different one once as long as a worker knows it; many new ones
go through a tokenizer as one text. Per block of documents every pair of ids
has an inverted list: compressed bitmaps of the documents, one per binary digit
of how often the pair is linked there (its multiplicity planes). The union of
the planes, counted, gives the pair's documents; sums over the blocks give the
counts of the corpus; and the bitmaps tell which documents to return them to.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabulare.llm.bpe import byte_symbols
from tabulare.llm.rows import held_by_worker, id_and_bytes, slices, without_collector
from tabulare.session import work_table

ASCII_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
WIDE_SPACE = [chr(c).encode() for c in range(128, 1 << 16) if chr(c).isspace()]
B_BITS = 20  # an id pair is one number
BLOCK_POSTINGS = 2_000_000
BLOCK_DOCS = 1 << 16  # places in a block have 16 bits
KNOWN_PARTS, KNOWN_LETTERS = 200_000, 8_000_000
PART_BYTES = 1 << 20
JOINED = 256
DENSE = 16


def cut_places(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes have a blank after other than white space."""
    at = np.flatnonzero(data[1:] == 32) + 1
    at = at[~ASCII_SPACE[data[at - 1]]]
    wide = np.flatnonzero(data[at - 1] >= 128)
    for char in WIDE_SPACE:
        here = at[wide]
        same = here >= len(char)
        for back, byte in enumerate(reversed(char), 1):
            same &= data[here - back] == byte
        at[wide[same]] = -1
        wide = wide[~same]
    return at[at > 0]


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts (binary), one after the other, and how many parts each text has; an empty text has none."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    filled = np.flatnonzero(np.diff(edges))
    at = cut_places(data)
    of = np.searchsorted(edges, at, "right") - 1
    at = at[(at > edges[of]) & (at < edges[of + 1] - 1)]  # neither first nor last of a text
    kept = np.ones(len(data), bool)
    kept[at] = False
    begins = np.sort(np.concatenate([edges[filled], at + 1]))
    sizes = np.diff(np.searchsorted(begins, edges))
    ends = np.append(begins - np.searchsorted(at, begins), len(data) - len(at))
    parts = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[kept]))
    return parts, sizes


class Sides:
    """Both tokenizers: ids of parts of texts, and the bytes of each id."""

    def __init__(self, byte_level: bytes, piece_model: bytes) -> None:
        self.left = Tokenizer.from_str(byte_level.decode())
        self.left.no_truncation()
        self.left.no_padding()
        self.left.encode_special_tokens = True
        self.right = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        of_symbol = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        names = (self.left.id_to_token(i) or "" for i in range(self.left.get_vocab_size(with_added_tokens=False)))
        left = [bytes(of_symbol[c] for c in name) if all(c in of_symbol for c in name) else name.encode() for name in names]
        right = [
            bytes([int(piece[3:5], 16)]) if self.right.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.right.id_to_piece(i)) for i in range(self.right.get_piece_size()))
        ]
        if any(re.search("[^▁]▁", self.right.id_to_piece(i)) for i in range(len(right))):
            raise ValueError("a piece goes over a blank: texts can't be cut there")
        self.bytes = left, right
        self.sizes = tuple(np.array(list(map(len, side)), np.int64) for side in self.bytes)
        self.table = tuple(pa.array(side, pa.large_binary()) for side in self.bytes)
        self.written = tuple(pa.array(map(str, range(len(side))), pa.string()) for side in self.bytes)

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each part on either side, as after a blank: the right tokenizer adds it by itself."""
        left = [found.ids for found in self.left.encode_batch_fast([f" {part}" for part in parts], add_special_tokens=False)]
        return left, self.right.encode(parts, num_threads=1)

    def encode_joined(self, parts: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray], list[np.ndarray], list[np.ndarray], list[str]]:
        """Parts without white space at their ends, many as one text: those encoded, their ids and how many of them each part has, and the rest.

        The rest are the parts of texts that the tokens of either side don't
        give back, or which have a token over the end of a part.
        """
        done, ids, sizes, rest = [], ([], []), ([], []), []
        chunks = [parts[i : i + JOINED] for i in range(0, len(parts), JOINED)]
        texts = [" ".join(chunk) for chunk in chunks]
        for chunk, text, *both in zip(chunks, texts, *self.encode(texts), strict=True):
            both = [np.array(side, np.int64) for side in both]
            ends = np.cumsum([len(part) + 1 for part in (chunk if text.isascii() else map(str.encode, chunk))])
            reached = [np.cumsum(own[side]) for own, side in zip(self.sizes, both, strict=True)]
            until = [np.searchsorted(found, ends, "right") for found in reached]
            whole = f" {text}".encode()
            taken = (own.take(pa.array(side)).buffers()[2] for own, side in zip(self.table, both, strict=True))
            if (
                all(len(found) and found[-1] == len(whole) for found in reached)
                and all(found[: len(whole)].to_pybytes() == whole for found in taken)
                and all((found[n - 1] == ends).all() for found, n in zip(reached, until, strict=True))
            ):
                done += chunk
                for k in (0, 1):
                    ids[k].append(both[k])
                    sizes[k].append(np.diff(until[k], prepend=0))
            else:
                rest += chunk
        return done, *ids, *sizes, rest

    def same_bytes(self, part: str, left: list[int], right: list[int]) -> bool:
        whole = f" {part}".encode()
        return b"".join(map(self.bytes[0].__getitem__, left)) == whole == b"".join(map(self.bytes[1].__getitem__, right))


def align(left: np.ndarray, right: np.ndarray, sizes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """The group of each token on the left and on the right, and all linked pairs, group by group; bytes on both sides are the same."""
    ends = np.cumsum(sizes[0][left]), np.cumsum(sizes[1][right])
    marks = np.zeros((2, ends[0][-1] + 1), bool)
    marks[0, ends[0]] = marks[1, ends[1]] = True
    common = np.flatnonzero(marks[0] & marks[1])
    groups = [np.searchsorted(common, end) for end in ends]
    many, few = (np.bincount(group, minlength=len(common)) for group in groups)
    links = many * few
    group = np.repeat(np.arange(len(common)), links)
    place = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
    first = (np.cumsum(many) - many)[group] + place // few[group]
    second = (np.cumsum(few) - few)[group] + place % few[group]
    return groups[0], groups[1], left[first].astype(np.int64) << B_BITS | right[second], np.cumsum(links)


class Parts:
    """What is known of parts of texts: the written groups, four sizes, and pairs (64 bits each); bounded.

    When there are enough, those known so far become old ones, which are dropped
    the next time unless they were asked for.
    """

    def __init__(self, sides: Sides) -> None:
        self.sides = sides
        self.known: dict[str, tuple[str | None, bytes, bytes]] = {}
        self.old: dict[str, tuple[str | None, bytes, bytes]] = {}
        self.letters = 0

    def learn(self, cut: list[list[str]]) -> None:
        """Encode and align the parts that are not known, as many at a time as memory allows."""
        if len(self.known) > KNOWN_PARTS or self.letters > KNOWN_LETTERS:
            self.known, self.old, self.letters = {}, self.known, 0
        fresh, held = [], 0
        for part in set().union(*cut):
            if part in self.known:
                continue
            found = self.old.get(part)
            if found:
                self.known[part] = found
                self.letters += len(part)
                continue
            fresh.append(part)
            held += len(part)
            if held > PART_BYTES:
                self._align(fresh)
                fresh, held = [], 0
        if fresh:
            self._align(fresh)

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[tuple[int, ...], str, np.ndarray]]:
        """Per text its four sizes, the digest of its groups, and its pairs; each different part is looked up once."""
        parts, n_parts = cut_texts(texts)
        if not len(parts):
            yield from [((0, 0, 0, 0), "", np.zeros(0, np.int64))] * len(texts)
            return
        coded = parts.dictionary_encode()
        names, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        self.learn([names])
        written, counts, links = zip(*map(self.known.__getitem__, names), strict=True)
        ends = np.concatenate([[0], np.cumsum(n_parts)])
        lost = np.array([part is None for part in written])[codes]
        lost = np.diff(np.concatenate([[0], np.cumsum(lost)])[ends]) > 0
        groups = pa.array([f"{part};" for part in written], pa.large_string()).take(coded.indices)
        _, offsets, letters = groups.buffers()
        until = np.frombuffer(offsets, np.int64)[ends].tolist()
        letters = memoryview(letters)
        totals = np.zeros((len(parts) + 1, 4), np.int64)
        np.cumsum(np.frombuffer(b"".join(counts), np.int32).reshape(-1, 4)[codes], 0, out=totals[1:])
        totals = np.diff(totals[ends], axis=0).tolist()
        size = np.array(list(map(len, links))) >> 3
        first = np.cumsum(size) - size
        pairs = np.frombuffer(b"".join(links), np.int64)
        reach = np.concatenate([[0], np.cumsum(size[codes])])
        for k, (begin, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            if begin == end or lost[k]:
                yield (0, 0, 0, 0), "", np.zeros(0, np.int64)
                continue
            own = codes[begin:end]
            place = np.repeat(first[own] - reach[begin:end], size[own]) + np.arange(reach[begin], reach[end])
            yield tuple(totals[k]), hashlib.sha256(letters[until[k] : until[k + 1] - 1]).hexdigest(), pairs[place]

    def _align(self, parts: list[str]) -> None:
        self.letters += sum(map(len, parts))
        plain, others = [], []
        for part in parts:
            (others if part[-1:].isspace() else plain).append(part)
        kept, lefts, rights, n_left, n_right, rest = self.sides.encode_joined(plain)
        others += rest
        n_left, n_right = (list(map(int, np.concatenate(n))) if n else [] for n in (n_left, n_right))
        for part, left, right in zip(others, *self.sides.encode(others), strict=True):
            if self.sides.same_bytes(part, left, right):
                kept.append(part)
                lefts.append(np.array(left, np.int64))
                rights.append(np.array(right, np.int64))
                n_left.append(len(left))
                n_right.append(len(right))
            else:
                self.known[part] = None, bytes(16), b""
        if not kept:
            return
        left, right = np.concatenate(lefts), np.concatenate(rights)
        group_l, group_r, pairs, links = align(left, right, self.sides.sizes)
        last = group_l[np.cumsum(n_left) - 1]  # the group in which each part ends
        n_groups, ends = np.diff(last, prepend=-1), links[last]
        starts = np.concatenate([[0], ends[:-1]])
        counts = np.array([n_left, n_right, n_groups, ends - starts], np.int32).T.tobytes()
        sides = (
            _joined(names.take(pa.array(ids)), np.bincount(groups), ",")
            for names, ids, groups in zip(self.sides.written, (left, right), (group_l, group_r), strict=True)
        )
        written = _joined(pc.binary_join_element_wise(*sides, "|"), n_groups, ";").to_numpy(zero_copy_only=False)
        data, same = pairs.tobytes(), {}  # few sizes differ: one object for those that are equal
        for k, (part, begin, end) in enumerate(zip(kept, (starts * 8).tolist(), (ends * 8).tolist(), strict=True)):
            own = counts[16 * k : 16 * k + 16]
            self.known[part] = written[k], same.setdefault(own, own), data[begin:end]


def _joined(values: pa.Array, sizes: np.ndarray, between: str) -> pa.Array:
    """Runs of values of the given sizes, each as one string."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), values), between)


def pack_bits(docs: np.ndarray) -> bytes:
    """A bitmap of ascending places below ``BLOCK_DOCS``: the places themselves, or for many of them, after one odd byte, all bits."""
    if len(docs) * DENSE < int(docs[-1]):
        return docs.astype("<u2").tobytes()
    bits = np.zeros(((int(docs[-1]) >> 4) + 1) * 16, np.uint8)
    bits[docs] = 1
    return b"\x01" + np.packbits(bits).tobytes()


def unpack_bits(data: bytes) -> np.ndarray:
    """The places in a bitmap of ``pack_bits``."""
    if len(data) % 2 == 0:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)[1:]))


def union(planes: list[bytes]) -> np.ndarray:
    """The places that any of the bitmaps has."""
    found = [unpack_bits(plane) for plane in planes if plane]
    if len(found) == 1:
        return found[0]
    bits = np.zeros(max(int(places[-1]) for places in found) + 1, bool)
    for places in found:
        bits[places] = True
    return np.flatnonzero(bits)


def inverted(pairs: np.ndarray, places: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, list[int], list[list[bytes]]]:
    """The lists of one block, a row per pair: the pair, its number of documents, and its multiplicity planes, lowest digit first."""
    if not len(pairs):
        return pairs, [], []
    order = np.argsort(pairs << 16 | places)
    pairs, places, times = pairs[order], places[order], times[order]
    edges = np.flatnonzero(np.diff(pairs, prepend=-1, append=-1))
    begins, ends = edges[:-1], edges[1:]
    docs = ends - begins  # all that the planes have together
    digits = np.frexp(np.maximum.reduceat(times, begins))[1]
    plain = (digits == 1) & (docs * DENSE < places[ends - 1])
    flat = places.astype("<u2").tobytes()
    planes = []
    for begin, end, last, simple in zip(begins.tolist(), ends.tolist(), digits.tolist(), plain.tolist(), strict=True):
        if simple:  # as pack_bits has it
            planes.append([flat[2 * begin : 2 * end]])
            continue
        own, often = places[begin:end], times[begin:end]
        layers = (own[often >> digit & 1 == 1] for digit in range(last))
        planes.append([pack_bits(layer) if len(layer) else b"" for layer in layers])
    return pairs[begins], docs.tolist(), planes


def scores(planes: list[list[bytes]], counts: np.ndarray, best: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per place: the sum of the pairs' counts over its links, and how many links have the best count of their left id."""
    total, links = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for digit in range(max(map(len, planes), default=0)):
        at = [i for i, own in enumerate(planes) if len(own) > digit and own[digit]]
        if not at:
            continue
        places = [unpack_bits(planes[i][digit]) for i in at]
        of = np.repeat(np.array(at), list(map(len, places)))
        flat = np.concatenate(places)
        np.add.at(total, flat, counts[of] << digit)
        np.add.at(links, flat, best[of].astype(np.int64) << digit)
    return total, links


class Block:
    """Some documents of a task, which are written with the lists of their pairs when there are enough of them."""

    NAMES = ("_block", "_place", "_id", "n_a", "n_b", "n_groups", "n_links", "groups", "_pair", "_docs", "_planes")
    KINDS = (*[pa.int64()] * 7, pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()))
    SCHEMA = (
        "_block bigint, _place bigint, _id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        "_pair bigint, _docs bigint, _planes array<binary>"
    )

    def __init__(self, number: int) -> None:
        self.number, self.rows, self.held = number, [], 0
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, key: int | None, sizes: tuple, written: str, pairs: np.ndarray) -> None:
        found, times = np.unique(pairs, return_counts=True)
        self.rows.append((self.number, len(self.rows), key, *sizes, written))
        self.pairs.append(found)
        self.times.append(times)
        self.held += len(found)

    def full(self) -> bool:
        return self.held >= BLOCK_POSTINGS or len(self.rows) == BLOCK_DOCS

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        places = np.repeat(np.arange(len(self.rows)), list(map(len, self.pairs)))
        pairs, docs, planes = inverted(np.concatenate(self.pairs), places, np.concatenate(self.times))
        blank: list = [None]
        parts = [
            [*map(list, zip(*self.rows, strict=True)), *[blank * len(self.rows)] * 3],
            [[self.number] * len(docs), *[blank * len(docs)] * 7, pairs.tolist(), docs, planes],
        ]
        for columns in parts:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.KINDS, strict=True)], names=list(self.NAMES))


def aligned_blocks(docs: DataFrame, byte_level: str, piece_model: str, key: str, text: str) -> DataFrame:
    """Rows of two kinds, by block: documents with their sizes and a digest of their groups, and the inverted lists of pairs."""
    files = []
    for path in (byte_level, piece_model):
        with open(path, "rb") as file:
            files.append(file.read())
    given = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        parts = held_by_worker("parts", tuple(map(hash, given.value)), lambda: Parts(Sides(*given.value)))
        task = TaskContext.get().partitionId() << 32
        block = Block(task)
        for batch in slices(batches):
            with without_collector():
                aligned = list(parts.of_texts(batch.column("_text")))
            for key_, own in zip(batch.column("_id").to_pylist(), aligned, strict=True):
                block.add(key_, *own)
                if block.full():
                    yield from block.batches()
                    block = Block(block.number + 1)
        yield from block.batches()

    return id_and_bytes(docs, key, text).mapInArrow(run, Block.SCHEMA)


def align_tokenizers(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with the scores of their links, and pairs of ids with their corpus-wide counts.

    The documents have ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum`` and ``groups_sha256``; the pairs ``a``, ``b``,
    ``docs`` and ``best``, whether no pair of the same ``a`` is in more. A null
    or empty text, or one whose bytes the tokens of either side don't give
    back, has no tokens: zeros and an empty digest. Special tokens' names are
    plain text. Repeated rows and null keys are documents of their own; an
    empty table gives no rows.

    A block holds ``BLOCK_POSTINGS`` pairs of documents or one document more,
    so memory is bounded; a pair has one row per block, however many documents
    link it. The best counts are one row per id of the left vocabulary.
    """
    blocks = work_table(aligned_blocks(docs, byte_level, piece_model, key, text), "blocks")
    lists = blocks.where(F.col("_pair").isNotNull())
    counted = lists.groupBy("_pair").agg(F.sum("_docs").alias("_count")).withColumn("_a", F.shiftright("_pair", B_BITS))
    counted = work_table(counted, "pairs")
    top = counted.groupBy(F.col("_a").alias("_of")).agg(F.max("_count").alias("_most"))  # a row per id of a vocabulary
    known = counted.join(F.broadcast(top), F.col("_a") == F.col("_of")).select(
        F.col("_pair").alias("_p"), "_a", "_count", (F.col("_count") == F.col("_most")).alias("_best")
    )

    def score(table: pa.Table) -> pa.Table:
        planes = table.column("_planes").to_pylist()
        size = 1 + max((int(union(own)[-1]) for own in planes), default=-1)
        total, links = scores(planes, table.column("_count").to_numpy(), table.column("_best").to_numpy(), size)
        return pa.table({"_b": [table.column("_block")[0].as_py()] * size, "_at": np.arange(size), "_sum": total, "_links": links})

    returned = (
        lists.join(known, F.col("_pair") == F.col("_p"))
        .select("_block", "_planes", "_count", "_best")
        .groupBy("_block")
        .applyInArrow(score, "_b bigint, _at bigint, _sum bigint, _links bigint")
    )
    rows = blocks.where(F.col("_pair").isNull()).join(returned, (F.col("_block") == F.col("_b")) & (F.col("_place") == F.col("_at")), "left")
    nothing = F.lit(0).cast("bigint")
    return rows.select(
        F.col("_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("_links", nothing).alias("n_best"), F.coalesce("_sum", nothing).alias("count_sum"),
        F.col("groups").alias("groups_sha256"),
    ), known.select(
        F.col("_a").alias("a"), F.col("_p").bitwiseAND((1 << B_BITS) - 1).alias("b"), F.col("_count").alias("docs"), F.col("_best").alias("best")
    )

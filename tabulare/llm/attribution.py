"""Token counts of sections: whole documents are encoded once, and tokens are dealt to sections by where they lie."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulare.llm.rows import id_and_bytes, slices

CACHE_ENTRIES = 400_000
NO_ID = -(1 << 63)


class Pieces(dict):
    """Where the tokens of a piece of text end, in bytes. Pieces are encoded alone, as the vocabulary's pattern cuts them."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        super().__init__()
        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.sizes = {rank: len(token) for token, rank in table.items()}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # The engine of the library takes for white space just what has that property.
        spaces = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.cut = regex.compile(spaces).findall
        self.bytes: dict[str, int] = {}

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
            self.bytes.clear()
        ends, total = [], 0
        for token in self.encoding.encode_ordinary(piece):
            total += self.sizes[token]
            ends.append(total)
        self[piece] = ends
        return ends


class Spans:
    """The tokens of one text by their byte spans, held piece by piece."""

    def __init__(self, text: str, known: Pieces) -> None:
        self.ends_in = [known[piece] for piece in known.cut(text)]
        self.piece_ends = np.cumsum([ends[-1] for ends in self.ends_in], dtype=np.int64)
        self.tokens = np.cumsum([len(ends) for ends in self.ends_in], dtype=np.int64)
        self.count = int(self.tokens[-1]) if len(self.tokens) else 0

    def at(self, place: int) -> tuple[int, tuple[int, int] | None]:
        """How many tokens end at or before a byte, and the span of the one that goes on over it, if any does."""
        piece = int(np.searchsorted(self.piece_ends, place, "right"))
        if piece == len(self.ends_in):
            return self.count, None
        start = int(self.piece_ends[piece - 1]) if piece else 0
        before = int(self.tokens[piece - 1]) if piece else 0
        ends = [0, *self.ends_in[piece]]
        for i, (low, high) in enumerate(pairwise(ends)):
            if start + high > place:
                return before + i, (start + low, start + high) if start + low < place else None
        raise AssertionError("a piece ends after its last token")


def deal(spans: Spans, sections: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Per section, a span of bytes, how many tokens are its own and how many of these cross one of its ends.

    A token within a section is its own. One that crosses an end goes to the
    section that holds most of its bytes, of equal ones to the first; one with
    most of its bytes in no section, but some in one, still goes to that one.
    """
    counts, crossing = [], {}
    for low, high in sections:
        (before, left), (upto, right) = spans.at(low), spans.at(high)
        whole = upto - before - (left is not None)
        counts.append([max(whole, 0), 0])
        for span in (left, right):
            if span is not None:
                crossing[span] = None
    for start, end in crossing:
        held = [min(end, high) - max(start, low) for low, high in sections]
        most = max(held)
        if most > 0:
            counts[held.index(most)][0] += 1
            counts[held.index(most)][1] += 1
    return [tuple(c) for c in counts]


def lines(raw: bytes) -> list[tuple[int, int]]:
    """Lines with their ends, as spans of bytes; an empty text is one empty line."""
    ends = [i + 1 for i, byte in enumerate(raw) if byte == 10] if len(raw) < 64 else (
        np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    ).tolist()
    cuts = [0, *ends] if ends and ends[-1] == len(raw) else [0, *ends, len(raw)]
    return list(pairwise(cuts))


def attribute_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    sections: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row per document and section: ``doc_id``, ``section``, ``start``, ``end``, ``n_tokens``, ``n_crossing``.

    ``sections`` has ``doc_id``, ``section``, ``start`` and ``end`` in code
    points; those of a document may not overlap. Without it the lines of a text
    are its sections, numbered from 0. Each text is encoded whole, so a token
    can lie across an end: see ``deal`` for whose it is. A null or empty text
    has one line without tokens; with ``sections`` a document without any gives
    no row, and ends beyond the text mean its end. Rows with the same key get
    the same sections; an empty table gives no rows. ``vocabulary`` is a path.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())
    rows = id_and_bytes(docs, key, text)
    if sections is None:
        rows = rows.withColumn("_sections", F.lit(None).cast("array<struct<start: bigint, end: bigint, section: bigint>>"))
    else:
        fields = (F.col(name).cast("bigint").alias(name) for name in ("start", "end", "section"))
        of_key = sections.groupBy(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("_k")).agg(
            F.sort_array(F.collect_list(F.struct(*fields))).alias("_sections")
        )
        rows = rows.join(of_key, F.coalesce("_id", F.lit(NO_ID)) == F.col("_k")).drop("_k")

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Pieces(ranks.value, pattern)
        names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
        for part in slices(batches):
            columns: list[list] = [[] for _ in names]
            for key, raw, given in zip(*(part.column(n).to_pylist() for n in ("_id", "_text", "_sections")), strict=True):
                value = raw.decode()
                first = None  # the byte of each character, where they differ
                if len(value) != len(raw):
                    data = np.frombuffer(raw, np.uint8)
                    first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))
                if given is None:
                    held = lines(raw)
                    numbers = range(len(held))
                    shown = held if first is None else np.searchsorted(first, np.array(held)).tolist()
                else:
                    shown = [(min(s["start"], len(value)), min(s["end"], len(value))) for s in given]
                    numbers = [s["section"] for s in given]
                    held = shown if first is None else [(int(first[a]), int(first[b])) for a, b in shown]
                counts = deal(Spans(value, known), held)
                for number, (start, end), (n, crossing) in zip(numbers, shown, counts, strict=True):
                    for column, field in zip(columns, (key, number, start, end, n, crossing), strict=True):
                        column.append(field)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    schema = "doc_id bigint, section bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
    return rows.select("_id", "_text", "_sections").mapInArrow(attribute, schema)

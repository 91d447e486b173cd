"""Helpers that several of the operators share: reading the two columns they need, and Arrow batches by size."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SLICE_BYTES = 4_000_000


def read_documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id`` and ``_text`` only, so that no other column can clash; a null text is an empty one."""
    return docs.select(F.col(key).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def packed(docs: DataFrame, **needed: str) -> DataFrame:
    """All columns in one struct ``_row``, beside the needed ones under own names: nothing an operator adds can clash."""
    return docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"),
        *(F.col(column).alias(name) for name, column in needed.items()),
    )


def id_and_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same with the text as its UTF-8 bytes."""
    return id_and_text(docs, key, text).select("_id", F.col("_text").cast("binary").alias("_text"))


def words(raw: bytes) -> list[bytes]:
    """The lower-cased words ``[^\\x20\\x09-\\x0D]+`` of a text: just the white space at which ``bytes.split`` splits."""
    return raw.translate(LOWER).split()


def slices(batches: Iterator[pa.RecordBatch], column: str = "_text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``most`` bytes of text, or of one row: memory follows the longest row, not the batch."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def held_by_worker(kind: str, name: Any, make: Callable[[], Any]) -> Any:
    """An object that the tasks of one Python worker share, one after the other; one of each kind, so that memory stays bounded."""
    held = sys.modules.setdefault("tabulare_worker", ModuleType("tabulare_worker")).__dict__
    if held.get(kind, (None,))[0] != name:
        held[kind] = name, make()
    return held[kind][1]


def let_go_by_worker(kind: str) -> None:
    """Drop what ``held_by_worker`` keeps, in a stage that has no use for it."""
    sys.modules.setdefault("tabulare_worker", ModuleType("tabulare_worker")).__dict__.pop(kind, None)


@contextmanager
def without_collector() -> Iterator[None]:
    """No search for cycles meanwhile: it goes over all that is held, again and again, where no cycles are made."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()

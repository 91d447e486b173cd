"""From raw documents to token ids: quality rules, exact and near copies, mixture, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulare.llm import bpe, exact, mixing, near, quality
from tabulare.llm.queries import WORD_BPE
from tabulare.llm.rows import read_documents
from tabulare.session import work_table

NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the rules calibrated on the labels.

    Null, empty and short texts have too few words and go; texts of any length
    are counted whole; rows with null or repeated keys are judged one by one.
    """
    return quality.keep_good(docs, read_documents(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest key; of rows with the same key and text one.

    A null text is an empty one; a null key is smaller than any other; texts of
    any length are compared whole.
    """
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word runs the one with the smallest key.

    Texts without words are linked with nothing and stay; a null key is smaller
    than any other; rows with the same key stay or go together.
    """
    return near.keep_one_each(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources interleave at their target weights.

    A null source is one like another; repeated rows follow each other. The
    order is that of the files written and of the rows in them.
    """
    return mixing.mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its place in the mixture, source, key, token ids and their number, and a digest of the decoded text.

    The place is that of the row in the table as it was written, counted from
    0. A null or empty text has no ids; repeated rows are encoded like others.
    """
    placed = mixing.written_order(docs).select("_position", "_row.*")
    lexicon = bpe.build_lexicon(docs, WORD_BPE)
    encoded = bpe.encode_decode(placed, WORD_BPE, lexicon, carried=("_position", "source"))
    return encoded.select(
        F.col("_position").alias("position"),
        "source",
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Encoding cannot be put in SQL; the rows are tested against plain Python instead.
ORACLE_SQL = None


def encoded_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the last stage, with ``position`` and ``source``: all stages in order, each written as Parquet and read again."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded documents in the order of the mixture; ``encoded_mixture`` has their positions and sources too."""
    return encoded_mixture(spark, sf_dir).orderBy("position").drop("position", "source")

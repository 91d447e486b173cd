"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulare.llm import alignment, attribution, bpe, exact, license, merkle, mixing, near, packing, pii, quality, repeats, scoring
from tabulare.llm.oracles import LLM_ORACLES  # noqa: F401
from tabulare.llm.rows import read_documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    found = bpe.encode_decode(docs, WORD_BPE, bpe.build_lexicon(docs, WORD_BPE))
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join("ids", " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(read_documents(spark, folder))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_minhash_near(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_groups(read_documents(spark, folder))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_dedup(read_documents(spark, folder))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    def listed(spans: Column) -> Column:
        parts = F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    found = pii.find_pii(read_documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.BASE_KINDS), sha256(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license.scan_licenses(read_documents(spark, folder))
    return found.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.get("matches", F.lit(0))["name"].alias("license"),
        F.get("matches", F.lit(0))["score"].alias("score"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("matches", lambda m: m["name"]))), ",").alias("names"),
    )


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_documents(read_documents(spark, folder))


def op8_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.attribute_tokens(read_documents(spark, folder), BYTE_BPE, public_tokenizers.PATTERN)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, folder), read_documents(spark, folder, "labels"))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(read_documents(spark, folder))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pack(read_documents(spark, folder), WORD_BPE)
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(read_documents(spark, folder)).drop("path")


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(read_documents(spark, folder), BYTE_LEVEL, PIECES)[0]


LLM_JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash_near": op3_minhash_near,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_pii": op5_pii,
    "op6_license_scan": op6_license_scan,
    "op7_lm_score": op7_lm_score,
    "op8_token_attribution": op8_token_attribution,
    "op9_quality_rules": op9_quality_rules,
    "op10_mix_sources": op10_mix_sources,
    "op11_packing": op11_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

"""The registered queries of this subpackage: thin applications of the operators to the tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import (
    byte_bpe,
    decontaminate,
    html_text,
    impact_topk,
    languages,
    near_dup,
    phrases,
    secret_scan,
    spellings,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.toxicity(table(spark, root, "documents"), table(spark, root, "labels"))


def op2_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.scan(table(spark, root, "documents"))


def op3_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, root, "documents"))
    return out.select("doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, root, "documents"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_impact_topk(spark: SparkSession, root: str) -> DataFrame:
    vectors = impact_topk.quantised(table(spark, root, "embeddings"), "vec_id", "embedding", 256.0)
    return impact_topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op6_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.leaks(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op7_html_text(spark: SparkSession, root: str) -> DataFrame:
    out = html_text.main_text(table(spark, root, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoded_digests(table(spark, root, "documents"), path)


def op9_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.token_counts(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_near_dup(spark: SparkSession, root: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, root, "documents"))


def op11_collocations(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents"))


def op12_language_id(spark: SparkSession, root: str) -> DataFrame:
    return languages.language_id(table(spark, root, "documents"))


def op13_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return spellings.variants(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_impact_topk": op5_impact_topk,
    "op6_decontaminate": op6_decontaminate,
    "op7_html_text": op7_html_text,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_counts": op9_token_counts,
    "op10_near_dup": op10_near_dup,
    "op11_collocations": op11_collocations,
    "op12_language_id": op12_language_id,
    "op13_spelling_variants": op13_spelling_variants,
}

STATEMENTS: dict[str, str] = {
    "op3_substring_dedup": substring_dedup.SQL,
    "op5_impact_topk": impact_topk.SQL,
    "op10_near_dup": near_dup.SQL,
    "op11_collocations": phrases.SQL,
    "op13_spelling_variants": spellings.SQL,
}

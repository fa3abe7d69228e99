"""The document pipeline: five stages, each written as Parquet and read again by the next.

1. toxicity: documents whose score reaches 0.7 go.
2. near_dup: of each component of near-duplicates the document with the smallest id stays;
   a repeated row stays once.
3. decontaminate: documents that hold a benchmark item, up to a fifth of its words changed, go.
4. secret_scan: secrets are replaced by a mark; all documents stay.
5. byte_bpe: the digests of the token ids and of the decoded bytes.

The first four return the columns of their input.  Documents with null or empty text pass
all stages; a row without an id cannot be matched by stage 2 and stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import byte_bpe, decontaminate, near_dup, secret_scan, toxicity
from stockweave.llm.store import stored

TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold; the model is trained on the labels of ``sf_dir``."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mark = "toxicity of this stage"
    return toxicity.score(docs, model, out_col=mark).where(F.col(f"`{mark}`") < TOXIC).drop(mark)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    found = near_dup.near_duplicates(docs).where("doc_id is not null")
    marks = stored(
        found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_and("kept").alias("kept")).where("rows > 1 or not kept"), "marks"
    )
    out = docs.join(marks.where("not kept").select("doc_id"), "doc_id", "left_anti")
    again = marks.where("kept").select("doc_id")
    if not again.isEmpty():
        once = out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        out = out.join(again, "doc_id", "left_anti").unionByName(once)
    return out.select(docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; n_chars follows the text."""
    return secret_scan.redact(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest rows of the documents that are left."""
    return byte_bpe.encoded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontaminate_stage),
    ("secret_scan", secret_stage),
    ("byte_bpe", byte_bpe_stage),
]

#: Label models, sketches and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

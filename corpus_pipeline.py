"""From raw documents to token ids, in five stages, each of which works on all that the one before kept.

Toxic documents go; of each group of near copies the one with the smallest id stays; documents that hold
a benchmark item go; personal data is replaced by its kind; the rest is encoded as byte-level BPE. The
result of each stage is written as Parquet to the shared folder and read again by the next one.

Rows without an id stay in every stage. Rows that share an id stay or go together. Other columns than
those of documents pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import bpe, decontam, minhash, pii, toxicity
from lakestar.llm.common import staged


def _chosen(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows of `docs` whose id is (left_semi) or is not (left_anti) among the ids; null is one."""
    ids = ids.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels, keep=True)
    return scored.where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return _chosen(docs, minhash.near_duplicates(docs).where("kept"), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _chosen(docs, decontam.contaminated(docs, items), "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind, and its length counted anew."""
    key = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").alias("_id"), "text", key.alias("_key"))
    found = pii.find_personal_data(rows).where(F.size("spans") > 0).dropDuplicates(["_id", "_key"])
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (key == found["_key"])
    text = pii.redact(F.col("text"), F.col("spans"))
    joined = docs.join(found, same, "left").withColumn("_new", F.when(F.col("spans").isNotNull(), text).otherwise(F.col("text")))
    new = {"text": F.col("_new"), "n_chars": F.when(F.col("spans").isNotNull(), F.length("_new").cast("long")).otherwise(F.col("n_chars"))}
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids`, and digests of the ids and of the bytes that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return bpe.encode(docs.select("doc_id", "text"), path, pattern, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Boosted trees and redaction are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None

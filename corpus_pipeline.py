"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; all but the last return the columns of ``documents``. ``run`` writes
every stage's rows as Parquet below the cluster's shared checkpoint folder and
reads them again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bpe, decontam, near_dup, quality_rules, secrets_scan
from ledgerlake.llm.queries import RANKS
from ledgerlake.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines frequent on their host."""
    return quality_rules.clean(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on five-word shingles."""
    return near_dup.one_of_each(spark, docs, size=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secrets_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digests of ids and decoded bytes."""
    keep = ["doc_id", "lang", "source"]
    done = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=keep, decoded="decoded")
    return bpe.digests(done, [*keep, "ids"])


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("decontamination", decontaminated),
          ("secret_scan", without_secrets), ("byte_bpe", tokens)]

#: Near-duplicates, decontamination and encoding are not expressible in SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and hands on the columns of `documents`;
the last one returns the tokens. `run` writes what a stage returns as Parquet into the shared folder of the session and
reads it again, so a stage never recomputes an earlier one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallybank.llm import bpe, decontaminate, repetition, secret_scan, simhash
from tallybank.llm.common import remove_folder, shared_folder, table
from tallybank.llm.registry import query


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the repetition rules go; null and empty texts are among them."""
    return repetition.keep_varied(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with markers in the place of secrets and n_chars set anew."""
    return secret_scan.redact_secrets(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them, of their offsets and of what they decode to."""
    encoded = bpe.encode(docs, offsets=False, decoded=True, digest_offsets=True)
    return encoded.select("doc_id", "n_tokens", "ids", bpe.digest("ids").alias("ids_sha256"), "offsets_sha256",
                          bpe.digest("decoded").alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("secret_scans", secret_scans),
          ("byte_level_bpe", byte_level_bpe)]

#: Fingerprints, windows and merges of tokens are beyond SQL; the tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage returns lies in the folder named in spark.checkpoint.dir until the next
    one has been written."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs


query("pipeline", ORACLE_SQL)(run)

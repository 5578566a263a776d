"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.llm import (bpe, chunks, decontaminate, langid, licenses, merkle, ngram_join, quality, repetition, secret_scan,
                           simhash, urls, whitening)
from tallybank.llm.common import table
from tallybank.llm.registry import query


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_license_scan", licenses.scan_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every whole document, and license notices among its lines."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from a bounded sample of the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, and all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_random",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that repeats across documents, at each of its places."""
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_substring_dedup_scopes")
def op6_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that repeats across documents or within one, at each of its places, marked by scope."""
    return chunks.all_passages(table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, their offsets, and what they decode to, as digests."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), offsets=False, decoded=True, digest_offsets=True)
    return encoded.select("doc_id", "n_tokens", bpe.digest("ids").alias("ids_sha256"), "offsets_sha256",
                          bpe.digest("decoded").alias("decoded_sha256"))


@query("op8_repetition_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, shares and verdict of the repetition rules for every document."""
    return repetition.repetition(table(spark, sf_dir, "documents"))


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return urls.judged(table(spark, sf_dir, "pages"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page and of every document. The trigram model counts all labelled documents."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    names, model = langid.text_model(langid.trigram_counts(docs))
    rows = langid.page_rows(pages).withColumn("kind", F.lit("page")).unionByName(
        langid.document_rows(docs).withColumn("kind", F.lit("document")))
    found = langid.identify(rows, names, model)
    return found.select(F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
                        F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
                        "declared", "text_lang", "lang", "confidence")


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding along the leading components of all of them."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_ngram_jaccard_join")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of five-word shingles, and its component of similar documents."""
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", merkle.tamper_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a copy with some texts changed still verifies."""
    return merkle.tamper_check(table(spark, sf_dir, "documents"))

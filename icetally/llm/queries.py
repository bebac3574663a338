"""The registered queries of this subpackage. They have no SQL twin unless SQL lists one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, centroids, decontaminate, fertility, lattice, lengths, licenses, line_dedup, ngram_join, pii, quality, secret_scan
from .answers import SQL
from .common import remainder, table, tune
from .spans import listed


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    tune(spark)
    return ngram_join.components_of(table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and how much of it was found."""
    tune(spark)
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice likelihood of every text, learned from all rows but the held-out fifth."""
    tune(spark)
    return lattice.score(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting rules and tokeniser fertility of every text."""
    tune(spark)
    return fertility.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


def _of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base spans as counts and digest, and all spans."""
    found = pii.redactions(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(_of_kind("base_spans", k) for k in pii.KINDS),
        F.sha2(listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: base spans as counts and digest, and all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(_of_kind("base_spans", k) for k in ("assign", "access", "hex")),
        F.sha2(listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text by a discriminant learned from all labelled rows outside the held-out fifth."""
    tune(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id")) != 0)
    return quality.score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact length histogram of all documents with the suffix sums for every length as a context limit."""
    tune(spark)
    return lengths.suffix_sums(lengths.histogram(table(spark, sf_dir, "documents")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every text, how many of them repeat an earlier line up to two edits, and the text without those."""
    tune(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduped(docs, drop_emptied=False).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    tune(spark)
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every text, with corpus-wide counts of the linked pairs."""
    tune(spark)
    return alignment.alignments(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every text: counts and places of the phrases, labels of both, a score."""
    tune(spark)
    word = F.transform("places", lambda p: p["word"])
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"), "base_labels", "labels", "score", F.size("notices").cast("bigint").alias("n_notices"),
    )


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rounds of centroid clustering over all kept vectors, with exact distances and inertia."""
    tune(spark)
    return centroids.clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_personal_data": op5_personal_data,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_line_dedup": op9_line_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_token_alignment": op11_token_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_centroid_clusters": op13_centroid_clusters,
}

__all__ = ["QUERIES", "SQL"]

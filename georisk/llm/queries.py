"""Registered queries of this subpackage over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from georisk.llm.embedding_pairs import cosine_links
from georisk.llm.fill_middle import fill_in_middle, restored
from georisk.llm.line_crf import score_quality
from georisk.llm.line_dedup import dedup_lines
from georisk.llm.mixing import mix_plan
from georisk.llm.ngram_join import jaccard_links
from georisk.llm.packing import pack_documents
from georisk.llm.quality_rules import rate_texts
from georisk.llm.spelling import spelling_variants
from georisk.llm.substring_dedup import repeated_passages
from georisk.llm.suffix_dedup import drop_repeats
from georisk.llm.toxicity import score_toxicity
from georisk.llm.warc_zip import archive_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes from each document."""
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share with an earlier one."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents placed in sequences of 1024."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, disguised words read first."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line counts of every text, and whether the rule cascade keeps it."""
    return rate_texts(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of embeddings with one label and a cosine of 0.93 or more."""
    return cosine_links(table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that others share, as a digest of what stays."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages archived in ZIP packages and read back by ranges."""
    return archive_round_trip(table(spark, sf_dir, "pages")).drop("url")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the labels of its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).drop("text")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of documents whose five-word shingles agree to 0.8 or more."""
    return jaccard_links(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent words a single edit away."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in fill-in-the-middle order, and the texts rebuilt from it, as digests."""
    moved = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without strings of 100 bytes that start earlier, as a digest of what stays."""
    found = drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc_zip": op8_warc_zip,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_suffix_dedup": op13_suffix_dedup,
}

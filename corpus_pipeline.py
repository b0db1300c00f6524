"""The corpus pipeline: clean, deduplicate, mix and pack documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from georisk.llm.line_crf import keep_good
from georisk.llm.line_dedup import dedup_lines
from georisk.llm.mixing import mix_texts
from georisk.llm.ngram_join import keep_one_per_group
from georisk.llm.packing import pack_documents
from georisk.workspace import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_sizes(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of documents, ``n_chars`` counted anew where there is one."""
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*names)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; documents left without a word go."""
    kept = dedup_lines(docs).where(~((F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    return with_sizes(kept, docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, as often as it takes them."""
    return with_sizes(mix_texts(docs), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# The classifier, the seeded draws and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}

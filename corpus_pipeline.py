"""A training-data pipeline over the documents table: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrimspark.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality
from scrimspark.llm.common import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.quality(docs).where("kept").select(*COLUMNS)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by similarities of 0.8 or more on 5-word shingles the smallest doc_id stays."""
    return ngram_join.first_of_each(docs, percent=80, width=5).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is there as often, and with as many of its words, as the mix takes."""
    return mixing.mixed_documents(mixing.mix_sources(docs), list(COLUMNS))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row of the mix as ids, with digests of the ids and of the bytes that they decode to."""
    return byte_bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]

#: SQL can't express the estimates of the first stage, the second join or the encoding; tests/llm/test_pipeline.py has a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, "pipeline-" + name.replace(" ", "-"))
    return docs

"""The corpus pipeline: quality, near copies, leaked benchmark items, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesmith.llm import bpe, jaccard, quality, secret_scan, tiling
from tablesmith.llm.staging import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores below its threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit_training_fold(docs, labels))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, near copies of copies included, the document with the smallest id stays."""
    return jaccard.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are replaced by a mark; no document goes."""
    return secret_scan.redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and whether decoding them gives the text back."""
    return bpe.encode_documents(docs, check=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

#: Learned scores and components over links are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs

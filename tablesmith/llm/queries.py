"""The numbered queries: each operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesmith.llm import (
    alignment, bpe, cascade, hmm, jaccard, langid, packing, paragraphs, quality, runs, secret_scan, tiling, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated(_table(spark, sf_dir, "documents"))


def op2_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents"))


def op4_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), digest=True)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op7_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(_table(spark, sf_dir, "documents"))


def op8_pack_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op9_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.quality_report(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(_table(spark, sf_dir, "documents"), rewrite=runs.made_periodic))


def op12_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(_table(spark, sf_dir, "documents"))


Q = {
    "op1_paragraph_minhash": op1_paragraph_minhash,
    "op2_attention_quality": op2_attention_quality,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_bpe_encode_decode": op4_bpe_encode_decode,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_hidden_markov_lm": op7_hidden_markov_lm,
    "op8_pack_token_ids": op8_pack_token_ids,
    "op9_benchmark_tiling": op9_benchmark_tiling,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_warc_transactions": op12_warc_transactions,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
SQL = {
    "op3_ngram_jaccard_join": jaccard.CLASSES_SQL,
    "op10_quality_cascade": cascade.REPORT_SQL,
    "op12_warc_transactions": warc.REPORT_SQL,
}

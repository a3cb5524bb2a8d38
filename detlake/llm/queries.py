"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, archive, bpe, decontaminate, extract, quality, rollup, secrets, simhash, toxicity
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document with corpus-wide ownership; owner is the source."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, docs["source"], F.concat_ws("/", docs["source"], docs["lang"])))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived by way of ARC streams, read back from the WARC files."""
    return archive.archive_and_read(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by merge replay, and their decoding."""
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after inserts, recounts and deletes."""
    return rollup.documents_history(spark, sf_dir)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it stays."""
    return quality.digest(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it contains."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_warc, op3_byte_bpe, op4_main_text, op5_token_rollup, op6_simhash, op7_toxicity, op8_vector_graph, op9_quality, op10_decontaminate)}
ORACLES = {"op1_secret_scan": secrets.ORACLE, "op2_warc": archive.ORACLE, "op5_token_rollup": rollup.ORACLE, "op10_decontaminate": decontaminate.ORACLE}

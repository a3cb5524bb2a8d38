"""A corpus pipeline: reject, deduplicate, decontaminate, redact, tokenize.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and works on all documents its predecessor kept.  A stage's result is written as
Parquet and read again as the next one's documents.

A document is known by its doc_id (null allowed) and a hash of its text, so
repeated ids do no harm; of rows repeated with id and text, the deduplication
keeps one.  Columns beyond those of ``documents`` pass through all stages.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detlake.llm import bpe, decontaminate, jaccard, quality, secrets
from detlake.llm.common import cut, small, table

HASH = "__text_hash"
#: The columns stages read; any other column only passes through.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage):
    """Give further columns neutral names while a stage works, so none can clash with its own.

    A further column that bears the name of a result gives way to it.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = {c: f"further_{i}" for i, c in enumerate(docs.columns) if c not in OWN}
        out = stage(spark, docs.select(*[docs[c].alias(more.get(c, c)) for c in docs.columns]), sf_dir)
        back = {v: k for k, v in more.items()}
        kept = [c for c in out.columns if back.get(c) is None or back[c] not in out.columns]
        return out.select(*[out[c].alias(back.get(c, c)) for c in kept])

    return run


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(HASH, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))


def _same(docs: DataFrame, other: DataFrame):
    return docs["doc_id"].eqNullSafe(other["__id"]) & (docs[HASH] == other["__hash"])


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))


@_apart
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within their language's quantile."""
    trusted = quality.trusted_documents(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, trusted).where("__keep").select(*docs.columns)


@_apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five-word shingles, similarity 0.8), the document with the least id."""
    found = cut(jaccard.near_duplicates(docs), "near-duplicates")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m"))
    stay = small(cut(first.select(F.col("m.doc_id").alias("__id"), F.col("m.text_hash").alias("__hash")), "stay"))
    rows = _hashed(docs)
    kept = rows.join(stay, _same(rows, stay), "left_semi")
    twice = cut(_keys(found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")), "repeated")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    twice = small(twice)
    once = kept.join(twice, _same(kept, twice), "left_anti")
    more = kept.join(twice, _same(kept, twice), "left_semi").dropDuplicates(["doc_id", HASH])
    return once.union(more).select(*docs.columns)


@_apart
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = decontaminate.contained(docs, table(spark, sf_dir, "benchmark"))
    gone = small(cut(_keys(found).distinct(), "contaminated"))
    rows = _hashed(docs)
    return rows.join(gone, _same(rows, gone), "left_anti").select(*docs.columns)


@_apart
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with owner-specific secrets and widely copied examples replaced by a mark each."""
    rows = _hashed(docs)
    found = secrets.scan(rows, rows["source"], F.concat_ws("/", rows["source"], rows["lang"]), keep=("doc_id", HASH))
    marked = found.where(F.size("marks") > 0).select(F.col("doc_id").alias("__id"), F.col(HASH).alias("__hash"), F.col("marks").alias("__marks")).dropDuplicates(["__id", "__hash"])
    marked = cut(marked, "marks")
    spans = marked.agg(F.sum(F.size("__marks"))).first()[0] or 0
    marked = F.broadcast(marked) if spans <= 500_000 else marked  # 17 bytes a span
    both = rows.join(marked, _same(rows, marked), "left")
    clean = F.when(F.col("__marks").isNull(), rows["text"]).otherwise(secrets.redact(rows["text"], F.col("__marks")))
    return both.select(*[clean.alias(c) if c == "text" else rows[c] for c in docs.columns])


@_apart
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with their digests and all columns but the text."""
    keep = tuple(c for c in docs.columns if c != "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=keep, with_ids=True, cache_words=250_000)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]

#: SQL can express neither the language model nor the fingerprints nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Token counts as delta-maintained rollups.

A delta row carries the sign of what happened to a document: inserted (+1),
deleted (-1) or revised (the old count taken back, the new one added, no change
in documents).  A batch of deltas is summed by source, language and tokenizer
version before it is stored; the store holds one partition per batch id, and a
commit replaces the partition of its own id only, so committing a batch again
- after a lost driver, say - changes nothing.  Totals are the sum over batches,
hence independent of their order.  Every partition holds a head row, so that an
empty batch replaces what its id held as well.

Nulls: a null text counts zero tokens; null source or language is its own
group.  Repeated rows count as often as they occur.  An empty batch is a batch
without totals.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import SPACE, cut, scratch_path, table

KEYS = ("source", "lang", "tokenizer")
ADDED = ("docs", "tokens", "n_inserts", "n_deletes", "n_revisions")
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, n_inserts long, n_deletes long, n_revisions long, head boolean, batch string"
TYPES = dict(c.split() for c in SCHEMA.split(", ")[:-2])


def word_count(text: Column) -> Column:
    """Words: runs between ASCII white space."""
    parts = F.split(text, SPACE, -1)  # one piece more than runs of white space; the first and last may be empty
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


#: Tokenizer versions and their counts; any Column function can join them.
TOKENIZERS = {"words-1": word_count, "utf8-1": lambda text: F.octet_length(text).cast("long")}


def inserts(counted: DataFrame) -> DataFrame:
    """Deltas of new documents, from (source, lang, tokenizer, n)."""
    return counted.select(*KEYS, F.lit("insert").alias("op"), F.lit(1).alias("docs"), F.col("n").alias("tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    """Deltas of documents that went, from the counts they were inserted with."""
    return counted.select(*KEYS, F.lit("delete").alias("op"), F.lit(-1).alias("docs"), (-F.col("n")).alias("tokens"))


def revisions(counted: DataFrame) -> DataFrame:
    """Deltas of recounted documents, from (source, lang, tokenizer, old, n)."""
    return counted.select(*KEYS, F.lit("revise").alias("op"), F.lit(0).alias("docs"), (F.col("n") - F.col("old")).alias("tokens"))


class Rollup:
    """Totals kept under ``path``, one partition per committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: str, deltas: DataFrame) -> None:
        """Store a batch; the same id again replaces what it stored."""
        is_op = lambda op: F.sum((F.col("op") == op).cast("long"))
        sums = deltas.groupBy(*KEYS).agg(
            F.sum(F.col("docs").cast("long")).alias("docs"), F.sum("tokens").alias("tokens"),
            is_op("insert").alias("n_inserts"), is_op("delete").alias("n_deletes"), is_op("revise").alias("n_revisions"),
        )
        rows = sums.select(*[F.col(c).cast(t) for c, t in TYPES.items()], F.lit(False).alias("head"))
        head = self.spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in TYPES.items()], F.lit(True).alias("head"))
        out = rows.union(head).withColumn("batch", F.lit(batch))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path)

    def batches(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def totals(self) -> DataFrame:
        """Additive totals by source, language and tokenizer version."""
        return self.batches().where("NOT head").groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ADDED])

    def compact(self, into: str) -> "Rollup":
        """The totals as the single batch of a new store."""
        other = Rollup(self.spark, into)
        self.totals().withColumns({"head": F.lit(False), "batch": F.lit("compacted")}).write.mode("overwrite").partitionBy("batch").parquet(into)
        return other


def count(docs: DataFrame, tokenizers: dict = TOKENIZERS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(source, lang, tokenizer, old, n) per document and tokenizer; ``old`` is the provisional count n_chars."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("tokenizer"), f(text).alias("n")) for name, f in tokenizers.items()]))
    rows = docs.select(*[docs[k] for k in keep], docs["source"], docs["lang"], F.coalesce(docs["n_chars"], F.lit(0)).cast("long").alias("old"), each.alias("c"))
    return rows.select(*keep, "source", "lang", "old", "c.*")


def count_bpe(docs: DataFrame, rank_file: str, pattern: str, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same columns from the operator of byte-level BPE; ``name`` is the tokenizer version."""
    kept = dict.fromkeys((*keep, "source", "lang", "n_chars"))
    found = bpe.encode(docs, rank_file, pattern, keep=tuple(kept))
    return found.select(*keep, "source", "lang", F.coalesce("n_chars", F.lit(0)).cast("long").alias("old"), F.lit(name).alias("tokenizer"), F.col("n_tokens").alias("n"))


def documents_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: every document inserted with its n_chars as provisional
    count, every count revised by the tokenizers, and the documents labelled as poor deleted.
    The last two are committed twice, as after a restart."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    store = Rollup(spark, scratch_path(spark, "rollup"))
    counted = cut(count(docs, keep=("doc_id",)), "counts")  # texts are read once, however often a batch is committed
    poor = labels.where("quality = 0").select("doc_id").distinct()
    store.commit("0001-load", inserts(counted.select("source", "lang", "tokenizer", F.col("old").alias("n"))))
    for _ in range(2):
        store.commit("0002-recount", revisions(counted))
        store.commit("0003-poor", deletes(counted.join(poor, "doc_id", "left_semi")))
    return store.totals()


ORACLE = r"""
WITH c AS (SELECT doc_id, source, lang, coalesce(n_chars, 0) AS old, unnest(['words-1', 'utf8-1']) AS tokenizer,
  unnest([len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), octet_length(encode(coalesce(text, '')))]) AS n FROM documents),
d AS (SELECT source, lang, tokenizer, 1 AS docs, old AS tokens, 'insert' AS op FROM c
  UNION ALL SELECT source, lang, tokenizer, 0, n - old, 'revise' FROM c
  UNION ALL SELECT source, lang, tokenizer, -1, -n, 'delete' FROM c WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0))
SELECT source, lang, tokenizer, sum(docs)::BIGINT AS docs, sum(tokens)::BIGINT AS tokens,
  count(*) FILTER (op = 'insert') AS n_inserts, count(*) FILTER (op = 'delete') AS n_deletes, count(*) FILTER (op = 'revise') AS n_revisions
FROM d GROUP BY source, lang, tokenizer
"""

"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

The model (``ngrams``) predicts unfolded characters from the four before them.
Its counts come from every trusted text and its tables grow with the corpus: they
stay sharded and are joined with the n-grams of the documents, gathered by block
and document before the shuffle.

A document is rejected if its mean surprise in nats a symbol lies above the
quantile ``QUANTILE`` of trusted documents in its language (of all trusted ones,
if its language has none), found exactly to 0.001 from histograms; there a trusted
document counts with the n-grams that only it holds as unseen.

A null language is a language of its own.  An empty or null text has no
perplexity and is rejected.  Without trusted text nothing is rejected but empty
texts.  Repeated rows are judged alike; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ngrams
from .common import cut, small

QUANTILE, BIN = 0.995, 0.001


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    row = counts.agg(*[F.sum((F.col("c") == j).cast("long")).alias(f"n{j}") for j in (1, 2, 3, 4)]).first()
    n = [0, *(float(row[f"n{j}"] or 0) for j in (1, 2, 3, 4))]
    y = n[1] / max(1.0, n[1] + 2 * n[2])
    return [min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[j] else 0.0, 0.05), j) for j in (1, 2, 3)]


def thresholds(scored: DataFrame, lang: str, score: str, quantile: float = QUANTILE) -> DataFrame:
    """(language or null for all, threshold): the least bin edge with ``quantile`` of the scores below it."""
    bins = scored.where(F.col(score).isNotNull()).groupBy(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("l"), F.floor(F.col(score) / BIN).alias("b")).agg(F.count("*").alias("n"))
    bins = cut(bins, "bins")  # a language has some thousand bins at most
    both = bins.union(bins.groupBy("b").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("l"), "b", "n"))
    w = Window.partitionBy("l")
    run = both.withColumn("upto", F.sum("n").over(w.orderBy("b"))).withColumn("all", F.sum("n").over(w))
    return run.where(F.col("upto") >= quantile * F.col("all")).groupBy("l").agg(((F.min("b") + 1) * BIN).alias("t"))


def trusted_documents(docs: DataFrame, labels: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The documents labelled as good (quality 1)."""
    good = labels.where((F.col("quality") == 1) & F.col(doc).isNotNull()).select(F.col(doc).alias("__id")).distinct()
    good = small(good)
    return docs.join(good, docs[doc] == good["__id"], "left_semi")


def scored_by(docs: DataFrame, scores: DataFrame, name: str, text: str = "text", score: str = "s") -> DataFrame:
    """``docs`` with the score ``name`` of each text (null: empty text)."""
    got = scores.select(F.col("h").alias("__h"), F.col(score).alias(name))
    return docs.join(small(got), F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == F.col("__h"), "left").drop("__h")


def classify(docs: DataFrame, trusted: DataFrame, lang: str = "lang", text: str = "text", keep: tuple[str, ...] | None = None, quantile: float = QUANTILE) -> DataFrame:
    """``keep`` columns with ``__surprise``, ``__threshold`` and ``__keep``; ``trusted`` are some of ``docs``."""
    model, base = ngrams.train(trusted, _discounts, text)
    scores = cut(ngrams.surprise(docs, model, base, text), "scores")
    known = thresholds(scored_by(trusted.select(trusted[lang], trusted[text]), scores, "__surprise", text, "own"), lang, "__surprise", quantile)
    known = small(cut(known, "thresholds"))
    every = known.where("l IS NULL").select(F.col("t").alias("__all"))
    general = (every.first() or {"__all": None})["__all"]
    keep = tuple(docs.columns) if keep is None else keep
    scored = scored_by(docs, scores, "__surprise", text).select(*[docs[k] for k in dict.fromkeys((*keep, lang))], "__surprise")
    own = known.where("l IS NOT NULL").select(F.col("l").alias("__l"), F.col("t").alias("__t"))
    out = scored.join(small(own), F.coalesce(scored[lang].cast("string"), F.lit("")) == F.col("__l"), "left")
    limit = F.coalesce(F.col("__t"), F.lit(general).cast("double"))
    kept = F.col("__surprise").isNotNull() & (limit.isNull() | (F.col("__surprise") < limit))
    return out.select(*[out[k] for k in keep], "__surprise", limit.alias("__threshold"), kept.alias("__keep"))


def digest(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = classify(docs, trusted_documents(docs, labels), keep=("doc_id", "lang"))
    return found.select("doc_id", "lang", F.exp("__surprise").alias("perplexity"), F.exp("__threshold").alias("threshold"), F.col("__keep").alias("keep"))

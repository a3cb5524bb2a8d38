"""Benchmark decontamination: size-partitioned MinHash containment search (DataFrame functions only).

A test item with n distinct word shingles is contained in a document when at
least ``threshold`` of them occur there.  Items are partitioned by size (powers
of two); in the partition with upper bound u an item's signature is the set of
its k least shingle hashes, k = floor((1 - threshold) u) + 1.  A document that
contains the item misses at most (1 - threshold) n of its shingles, so it must
hold one of any k: probing documents with the signatures alone loses nothing.
Candidates are then verified by exact containment of the shingles themselves.

Words are runs of letters, marks and digits, lower-cased; a text of fewer than
``size`` words has one shingle, its whole sequence, and one without words none,
so such an item matches nothing.  Documents are also probed with shingles of the
lengths of such short items, so these are found inside longer documents.  Null texts are empty.  A row is known by its
doc_id (null allowed) and its text; repeated rows give one result.  Repeated
items are separate items.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small, small_bytes

WORDS = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS, -1), lambda w: w != "")


def _starts(w: Column, size: int) -> Column:
    n = F.size(w)
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))))


def shingles(w: Column, size: int = 5) -> Column:
    """Distinct shingles of a word array, as strings."""
    return F.array_distinct(F.transform(_starts(w, size), lambda i: F.concat_ws(" ", F.slice(w, i + 1, size))))


def shingle_hashes(h: Column, size: int = 5) -> Column:
    """Hashes of the shingles from the words' hashes ``h`` (missing words of a short text: null)."""
    return F.transform(_starts(h, size), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))


def signatures(items: DataFrame, item: str, text: str, size: int, threshold: float) -> tuple[DataFrame, DataFrame, list[int]]:
    """(hash, item) rows of all signatures, (item, shingles), and the lengths of items shorter than a shingle."""
    rows = items.select(F.col(item).alias("item_id"), words(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("w"), F.monotonically_increasing_id().alias("nth"))
    rows = rows.select("item_id", "nth", shingles(F.col("w"), size).alias("shingles"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"), F.size("w").alias("words"))
    rows = rows.where(F.size("shingles") > 0)
    rows = cut(rows.select("item_id", "nth", "words", "shingles", F.array_sort(F.array_distinct(shingle_hashes(F.col("h"), size))).alias("h")), "items")
    short = sorted(r["words"] for r in rows.where(F.col("words") < size).select("words").distinct().collect())
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("h"))))
    least = (F.floor(F.round(upper * (1 - threshold), 6)) + 1).cast("int")
    return rows.select(F.explode(F.slice("h", 1, least)).alias("hash"), "nth"), rows.select("nth", "item_id", "shingles"), short


def contained(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document and item it contains.

    Columns ``doc_id``, ``text_hash`` (with doc_id it names the row), ``item_id``,
    ``n_item``, ``n_shared`` (distinct shingles), ``containment``.
    """
    sig, known, short = signatures(items, item, item_text, size, threshold)
    body = docs.select(docs[doc].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("body"))
    body = body.withColumn("text_hash", F.xxhash64("body"))
    hashed = body.select("doc_id", "text_hash", F.transform(words(F.col("body")), lambda x: F.xxhash64(x)).alias("h"))
    probes = hashed.select("doc_id", "text_hash", F.explode(F.concat(*[shingle_hashes(F.col("h"), n) for n in (size, *short)])).alias("hash"))
    found = probes.join(small(sig), "hash").groupBy("doc_id", "text_hash", "nth").agg(F.count("*").alias("n"))
    found = cut(found.drop("n"), "candidates")

    keys = found.select("doc_id", "text_hash").distinct()
    asked = found.join(small_bytes(known, F.octet_length(F.array_join("shingles", "")) + 32 * F.size("shingles")), "nth").groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "nth", "shingles")).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    few = small(keys)
    hit = body.join(few, same(body, few), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    both = hit.join(asked, same(hit, asked)).select(hit["doc_id"], hit["text_hash"], words(hit["body"]).alias("w"), asked["items"])
    both = both.select("doc_id", "text_hash", F.concat(*[shingles(F.col("w"), n) for n in (size, *short)]).alias("own"), "items")
    pairs = both.select(
        "doc_id", "text_hash",
        F.inline(F.transform("items", lambda x: F.struct(
            x["item_id"].alias("item_id"), F.size(x["shingles"]).cast("long").alias("n_item"),
            F.size(F.array_intersect(x["shingles"], F.col("own"))).cast("long").alias("n_shared")))),
    )
    return pairs.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= threshold)


ORACLE = r"""
WITH w AS (SELECT doc_id, hash(text) AS th, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
d AS (SELECT DISTINCT doc_id, th, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS nth, item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT DISTINCT nth, item_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM q WHERE len(w) > 0),
n AS (SELECT nth, count(*) AS n_item FROM i GROUP BY nth)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, count(*)::BIGINT AS n_shared, count(*) / n_item::DOUBLE AS containment
FROM d JOIN i USING (s) JOIN n USING (nth) GROUP BY doc_id, th, nth, item_id, n_item HAVING count(*) / n_item::DOUBLE >= 0.8
"""

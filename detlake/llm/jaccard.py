"""Near-duplicates by word shingles: the fingerprint operator's links and MinHash candidates, each verified by exact Jaccard similarity.

The fingerprints of ``simhash`` find what lies within three bits for certain.
But texts of similarity 0.8 differ in some ten of 64 bits, and beyond seven no
positional byte need be equal: an index of bytes can't find them.  So the
``BANDS`` x ``ROWS`` least hashes of a text's shingles are taken as well, and
texts that agree in a band form a list.  Two texts of similarity 0.8 share a list
with probability 0.99997.  First, each text is paired with the next of its list;
since the order is the same in every list, a group of copies yields few pairs
however large it is, and a long list is split among tasks.  A pair is a link only
if the similarity of its full shingle sets reaches the bound; a group is a
component of links.

Then lists whose members aren't all in one group are compared in full: a member
outside the list's largest group with all members of other groups.  Their shingle
sets come to the list, where an inverted index counts what is shared: a text is
looked up by as few of its rarest shingles as any text at the bound must meet one
of, and what meets enough of them is counted in full.  Only links that join two
groups leave the list, so the rows are one for each membership and at most one
less than there are groups.  Lists over ``BLOCK`` members or ``BLOCK_BYTES`` are
divided into blocks, and each block of members outside the largest group meets
every block in a cell of its own.
Null texts are empty; texts without words are alike only if they are equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, resident, small, width
from .simhash import components, fingerprint, text_hashes
from .simhash import links as print_links

BANDS, ROWS, LIKELY = 20, 4, 46
#: Members, and bytes of their shingle sets, in a block of a list that is compared in full.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
_rng = np.random.default_rng(6)
XOR, TIMES = (_rng.integers(0, 1 << 63, BANDS * ROWS, "u8") << np.uint64(1) | np.uint64(1) for _ in range(2))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hashes of a text from its distinct hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, "u8")
    for at in range(0, len(hashes), 4096):
        np.minimum(least, ((hashes[at : at + 4096, None] ^ XOR) * TIMES).min(0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A key for every band."""
    return (least.reshape(BANDS, ROWS) * TIMES[:ROWS]).sum(1, dtype="u8").view("i8")


def postings(prints: DataFrame) -> DataFrame:
    return prints.select("h", F.posexplode("keys").alias("band", "key"))


def candidates(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of texts that are neighbours in a list."""
    post = postings(prints).repartitionByRange(width(prints), "band", "key", "h").sortWithinPartitions("band", "key", "h")

    def run(batches):
        last = [np.zeros(0, "i8")] * 3
        for batch in batches:
            h, band, key = (np.concatenate([t, batch.column(c).to_numpy()]) for t, c in zip(last, ("h", "band", "key"), strict=True))
            same = np.flatnonzero((band[1:] == band[:-1]) & (key[1:] == key[:-1]))
            last = [x[-1:] for x in (h, band, key)]
            yield pa.RecordBatch.from_arrays([pa.array(h[same]), pa.array(h[same + 1])], ["a", "b"])

    return post.select("h", "band", "key").mapInArrow(run, "a long, b long").where("a < b").distinct()


def same_prints(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts whose fingerprints are equal or linked: each with the first of its own, and the first of linked ones."""
    first = cut(prints.groupBy("fp").agg(F.min("h").alias("first")), "first-of-prints")
    own = prints.join(first, "fp").select(F.col("first").alias("a"), F.col("h").alias("b"))
    near = print_links(first).join(first.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    return own.union(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).where("a <> b").distinct()


def divided_members(prints: DataFrame, tied: DataFrame) -> DataFrame:
    """(band, key, h, root) of the lists with members of several groups; neighbours have settled lists of two."""
    post = postings(prints).join(small(tied), "h", "left").withColumn("root", F.coalesce("root", "h"))
    ends = post.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = cut(ends.where("n > 2 AND lo <> hi").select("band", "key"), "divided-lists")
    return cut(post.join(small(several), ["band", "key"]), "divided-members")


def divided_lists(prints: DataFrame, tied: DataFrame) -> DataFrame:
    """Pairs (a, b) of different groups that are likely similar, from lists with members of several groups.

    By the agreement of the least hashes (``LIKELY`` of them, five deviations under what similarity 0.8 gives).  The pairs
    grow with the square of a list: this is the plain form that ``joining_links`` is tested against.
    """
    rows = divided_members(prints, tied)
    by_group = rows.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    most = by_group.groupBy("band", "key").agg(F.max_by("root", F.struct("n", "root")).alias("most"))
    rows = rows.join(most, ["band", "key"]).join(prints.select("h", "least"), "h").withColumn("far", F.col("root") != F.col("most"))
    rows = rows.repartition(width(prints), "band", "key").sortWithinPartitions("band", "key", F.desc("far"), "h")

    def close(held):
        h, root, far = (np.concatenate([x[i] for x in held]) for i in range(3))
        least = np.concatenate([x[3] for x in held])
        found = []
        for i in range(int(far.sum())):
            rest = slice(i + 1, None)
            at = np.flatnonzero(((least[rest] == least[i]).sum(1) >= LIKELY) & (root[rest] != root[i])) + i + 1
            found += [(min(h[i], x), max(h[i], x)) for x in h[at].tolist()]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    def run(batches):
        held, last = [], None
        for batch in batches:
            band, key, h, root = (batch.column(c).to_numpy() for c in ("band", "key", "h", "root"))
            far = batch.column("far").to_numpy(zero_copy_only=False)
            least = np.frombuffer(b"".join(batch.column("least").to_pylist()), "u1").reshape(len(h), -1)
            bounds = [0, *(np.flatnonzero((np.diff(band) != 0) | (np.diff(key) != 0)) + 1).tolist(), len(h)]
            for x, y in zip(bounds, bounds[1:], strict=False):
                if x == y:
                    continue
                if (band[x], key[x]) != last:
                    if held:
                        yield close(held)
                    held, last = [], (band[x], key[x])
                held.append((h[x:y], root[x:y], far[x:y], least[x:y]))
        if held:
            yield close(held)

    return rows.select("band", "key", "h", "root", "far", "least").mapInArrow(run, "a long, b long").distinct()


def shingle_sets(texts: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """(h, set), the sorted shingle hashes of every text asked for; ``texts`` has (h, t)."""

    def sets(batches):
        for batch in batches:
            found = [np.unique(np.array(text_hashes(t.as_py(), size), "u8")).tobytes() for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(found, pa.binary())], ["h", "set"])

    return cut(texts.join(small(asked), "h", "left_semi").dropDuplicates(["h"]).mapInArrow(sets, "h long, set binary"), "shingles")


def join_groups(sets: list[np.ndarray], group: np.ndarray, probes: np.ndarray, targets: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Index pairs (probe, target) of similarity ``least`` or more that join all groups such pairs join.

    ``group``, ``probes`` and ``targets`` (flags) have an entry for each set; a pair within a group, given or joined, is passed over.
    """
    group, found = group.copy(), []
    sizes = np.fromiter(map(len, sets), "i8", len(sets))
    ends = np.cumsum(sizes)
    _, token, held_by = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(token, kind="stable")]
    upto = np.cumsum(held_by)
    tally = lambda tokens: np.bincount(np.concatenate([holders[upto[k] - held_by[k] : upto[k]] for k in tokens.tolist()]), minlength=len(sets))
    for i in np.flatnonzero(probes).tolist():
        mine = sizes[i]
        other = np.flatnonzero(targets & (group != group[i]) & (sizes >= least * mine - 1e-6) & (sizes * least <= mine + 1e-6))
        if not len(other):
            continue
        need = np.maximum(1, np.ceil(least * (mine + sizes[other]) / (1 + least) - 1e-6).astype("i8"))  # shingles both must hold
        tokens = token[ends[i] - mine : ends[i]]
        tokens = tokens[np.argsort(held_by[tokens], kind="stable")]
        first = mine - int(need.min()) + 1  # of any so many, a similar text holds one
        rare = tokens[:first]
        rare = rare[held_by[rare] > 1]
        if not len(rare):
            continue
        hits = tally(rare)[other]
        near = hits >= first - (mine - need)
        if not near.any():
            continue
        other = other[near]
        shared = tally(tokens)[other]
        other = other[shared >= least * (mine + sizes[other] - shared) - 1e-9]
        _, at = np.unique(group[other], return_index=True)
        for j in other[at].tolist():
            group[group == group[j]] = group[i]
            found.append((i, j))
    return found


def joining_links(prints: DataFrame, tied: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Links (a, b) that join the groups of ``tied`` as all links within lists do; ``texts`` has (h, t)."""
    rows = divided_members(prints, tied)
    full = shingle_sets(texts, rows.select("h").distinct(), size)
    rows = rows.join(full.select("h", F.octet_length("set").cast("long").alias("bytes")), "h")
    by_group = rows.groupBy("band", "key", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    lists = by_group.groupBy("band", "key").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max_by(F.struct("root", "n", "bytes"), F.struct("n", "root")).alias("most"))
    blocks = lambda n, size: F.least(n, F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES))).cast("int")
    whole = (F.col("n") <= BLOCK) & (F.col("bytes") <= BLOCK_BYTES)
    lists = lists.select(
        "band", "key", F.col("most.root").alias("most"),
        F.when(whole, 1).otherwise(blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes"))).alias("outer"),
        F.when(whole, 0).otherwise(blocks(F.col("most.n"), F.col("most.bytes"))).alias("inner"),
    )
    rows = rows.join(lists, ["band", "key"]).withColumn("far", F.col("root") != F.col("most"))
    at = F.when(F.col("inner") == 0, 0).when(F.col("far"), F.pmod("h", "outer")).otherwise(F.col("outer") + F.pmod("h", "inner")).cast("int")
    with_all = F.transform(F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1), lambda j: F.struct(F.least("at", j).alias("i"), F.greatest("at", j).alias("j")))
    with_outer = F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda i: F.struct(i.alias("i"), F.col("at").alias("j")))
    cells = rows.withColumn("at", at).withColumn("cell", F.explode(F.when(F.col("at") < F.col("outer"), with_all).otherwise(with_outer)))
    cells = cells.select("band", "key", "cell.i", "cell.j", "h", "root", "far", "at").join(full, "h")
    cells = cells.repartition(width(prints), "band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "h")

    def close(held):
        h, root, far, at, i = (np.concatenate([x[k] for x in held]) for k in range(5))
        j = held[0][5]
        sets = [np.frombuffer(s, "u8") for x in held for s in x[6]]
        found = join_groups(sets, np.unique(root, return_inverse=True)[1], far & (at == i), at == j, least)
        a, b = (h[[x[k] for x in found]] if found else np.zeros(0, "i8") for k in range(2))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held, last = [], None
        for batch in batches:
            cell = [batch.column(c).to_numpy() for c in ("band", "key", "i", "j")]
            h, root, at = (batch.column(c).to_numpy() for c in ("h", "root", "at"))
            far = batch.column("far").to_numpy(zero_copy_only=False)
            new = np.zeros(max(0, len(h) - 1), bool)
            for c in cell:
                new |= np.diff(c) != 0
            bounds = [0, *(np.flatnonzero(new) + 1).tolist(), len(h)]
            for x, y in zip(bounds, bounds[1:], strict=False):
                if x == y:
                    continue
                if (this := tuple(int(c[x]) for c in cell)) != last:
                    if held:
                        yield close(held)
                    held, last = [], this
                held.append((h[x:y], root[x:y], far[x:y], at[x:y], cell[2][x:y], this[3], batch.column("set")[x:y].to_pylist()))
        if held:
            yield close(held)

    return cells.select("band", "key", "i", "j", "h", "root", "far", "at", "set").mapInArrow(run, "a long, b long").distinct()


def links(texts: DataFrame, pairs: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs whose shingle sets have Jaccard similarity ``least`` or more; ``texts`` has (h, t)."""
    full = shingle_sets(texts, pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), size)

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(s.as_py(), "u8") for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and both >= least * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(full.select(F.col("h").alias("a"), F.col("set").alias("x")), "a").join(full.select(F.col("h").alias("b"), F.col("set").alias("y")), "b")
    return both.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``root`` (names the component)."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[doc].alias("doc_id"), F.xxhash64(body).alias("h"), body.alias("t"))

    def run(batches):
        resident("jaccard")
        for batch in batches:
            keys, low, prints = [], [], []
            for t in batch.column("t"):
                hashes = text_hashes(t.as_py(), size)
                sig = signature(np.unique(np.array(hashes, "u8")))
                keys.append(bands(sig).tolist() if hashes else [])
                low.append((sig >> np.uint64(8)).astype("u1").tobytes() if hashes else b"")
                prints.append(fingerprint(hashes) if hashes else None)
            fp = pa.array([None if x is None else x - (x >> 63 << 64) for x in prints], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary()), fp], ["doc_id", "h", "keys", "least", "fp"])

    prints = cut(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, h long, keys array<long>, least binary, fp long"), "prints")
    texts = cut(prints.where("fp IS NOT NULL").groupBy("h").agg(*[F.first(c).alias(c) for c in ("keys", "least", "fp")]), "texts")
    pairs = cut(candidates(texts).union(same_prints(texts.select("fp", "h"))).distinct(), "pairs")
    found = cut(links(rows.select("h", "t"), pairs, size, least), "links")
    tied = components(found).withColumnRenamed("node", "h")
    more = cut(joining_links(texts, tied, rows.select("h", "t"), size, least), "links-of-divided-lists")
    if not more.isEmpty():
        tied = components(found.union(more)).withColumnRenamed("node", "h")
    return prints.select("doc_id", "h").join(tied, "h", "left").select("doc_id", F.col("h").alias("text_hash"), F.coalesce("root", "h").alias("root"))

"""SimHash near-duplicates through an index of positional bytes.

A 64-bit fingerprint has eight positional bytes.  Two fingerprints that differ
in at most three bits agree in at least five of them, and so in all four bytes
of some block of the Steiner system S(3, 4, 8): its 14 blocks are such that any
three positions lie in one, hence miss its complement, which is a block too.
The inverted index therefore lists fingerprints by (block, its four bytes): 14
postings each, and every link meets in at least one list.  Within a list pairs
are tallied (equal positional bytes), those under the guaranteed minimum of five
fall out, the rest are verified by counting bits.

Only distinct fingerprints are indexed, so copies cost one posting.  A list
never turns into all its pairs: links that already follow from others are not
emitted (at most one row less than the list has members), and a long list is
split again by the bits left over, by the same argument, until parts are short.

Null texts are empty; a text without words has fingerprint zero and is linked
like any other.  Rows with null doc_id take part; a component's id is its least
doc_id that is not null.  Repeated rows and repeated ids keep a row each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, resident

BITS, BYTES, MOST, LEAST_EQUAL = 64, 8, 3, 5
#: Members up to which a list is compared pair by pair, in one numpy call.
DIRECT = 1024


def steiner_blocks() -> list[tuple[int, ...]]:
    """The 14 blocks of S(3, 4, 8): four of the points 0..7 whose numbers XOR to zero."""
    return [b for b in combinations(range(BYTES), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]


BLOCKS = steiner_blocks()


def text_hashes(text: str, size: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of every word shingle, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [hash64(b" ".join(words), seed)]
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [hash64(flat[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """Bit set where over half of the hashes have it."""
    if not hashes:
        return 0
    counts = np.zeros(BITS, "i8")
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], "<u8")
        counts += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = 3) -> DataFrame:
    """``keep`` columns, ``fp`` (signed 64 bits) and ``text_hash``."""
    rows = docs.select(*[docs[k] for k in keep], F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumn("text_hash", F.xxhash64("_text"))
    schema = T.StructType([rows.schema[k] for k in keep] + [rows.schema["text_hash"], T.StructField("fp", T.LongType(), False)])

    def run(batches):
        resident("simhash")
        for batch in batches:
            prints = [fingerprint(text_hashes(t.as_py(), size)) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), batch.column("text_hash"), pa.array(np.array(prints, "<u8").view("<i8"))], schema.names
            )

    return rows.mapInArrow(run, schema)


class _Union:
    """Union-find over the members of one list; remembers the links that joined something."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[max(ra, rb)] = min(ra, rb)
            self.links.append((a, b))


def _compare(fps: np.ndarray, at: np.ndarray, sets: _Union) -> None:
    diff = fps[at][:, None] ^ fps[at][None, :]
    tally = (diff.view("u1").reshape(len(at), len(at), 8) == 0).sum(2, dtype="u1")  # shared positional bytes
    i, j = np.nonzero(np.triu(tally >= LEAST_EQUAL, 1))  # the others can't be near
    near = np.bitwise_count(diff[i, j]) <= MOST
    for a, b in zip(at[i[near]].tolist(), at[j[near]].tolist(), strict=True):
        sets.join(a, b)


def _link(fps: np.ndarray, at: np.ndarray, free: list[int], sets: _Union) -> None:
    """Join all near members ``at``, which agree in every bit that isn't ``free``."""
    if len(free) <= MOST:
        for i in at[1:]:
            sets.join(int(at[0]), int(i))
        return
    if len(at) <= DIRECT:
        _compare(fps, at, sets)
        return
    for g in range(MOST + 1):  # one of four groups of bits is equal in any near pair
        mine, rest = free[g :: MOST + 1], [b for i, b in enumerate(free) if i % (MOST + 1) != g]
        key = np.bitwise_and(fps[at], np.uint64(sum(1 << b for b in mine)))
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for run in np.split(at[order], cuts):
            if len(run) > 1:
                _link(fps, run, rest, sets)


def link_list(fps: np.ndarray, block: tuple[int, ...]) -> list[tuple[int, int]]:
    """Index pairs that connect all near members of one list of distinct fingerprints."""
    sets = _Union(len(fps))
    _link(fps, np.arange(len(fps)), [b for b in range(BITS) if b // 8 not in block], sets)
    return sets.links


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect whatever lies within three bits."""
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    key = lambda block: sum((F.shiftleft(byte(p), 8 * i) for i, p in enumerate(block[1:], 1)), byte(block[0]))
    post = prints.select("fp", F.posexplode(F.array(*[key(b) for b in BLOCKS])).alias("block", "bytes"))
    post = post.repartition("block", "bytes").sortWithinPartitions("block", "bytes")

    def run(batches):
        held: list[np.ndarray] = []
        last = None

        def close():
            fps = np.concatenate(held)
            return [(fps[i], fps[j]) for i, j in link_list(fps.view("<u8"), BLOCKS[last[0]])] if len(fps) > 1 else []

        for batch in batches:
            fp, block, byts = (batch.column(c).to_numpy() for c in ("fp", "block", "bytes"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(byts) != 0)) + 1
            bounds = [0, *cuts.tolist(), len(fp)]
            found = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                this = (int(block[a]), int(byts[a]))
                if this != last:
                    if held:
                        found += close()
                    held, last = [], this
                held.append(fp[a:b])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])
        if held and (found := close()):
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return post.select("block", "bytes", "fp").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), by alternating large and small stars.

    Each round hooks neighbours onto least neighbours; rounds are written to the
    shared folder, so a lost executor repeats one round at most.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = cut(pairs, "edges")
    seen = None
    for _ in range(most_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = cut(small.where("u <> v").distinct(), "stars")
        mark = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``fp``, ``root`` (a fingerprint that names the component), ``component_id``."""
    prints = fingerprints(docs.select(docs[doc].alias("doc_id"), docs[text].alias("text")), size=size)
    prints = cut(prints, "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    tied = components(links(distinct)).withColumnRenamed("node", "fp")
    ids = distinct.join(tied, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = ids.join(least, "root").select("fp", "root", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

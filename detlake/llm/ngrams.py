"""An interpolated modified Kneser-Ney model of unfolded characters whose tables grow with the corpus.

The symbols are all code points, with a mark before and one after a text; the
order is ``N``.  Counts, discounts, context totals and back-off weights are
tables of Spark, keyed by the n-gram itself; nothing bounds their rows.

A probability is a sum of looked-up values: with D(g) = log p(g) - log gamma(context
of g) - log p(g without its first symbol) for seen n-grams, and 0 for unseen
ones, log p is the sum of D over an n-gram and its endings, and of log gamma over
its contexts.  An n-gram that ends at one symbol is the context of the next, so
D + log gamma is one value a key, and a symbol's log probability is the sum of the
values of the n-grams of all orders that end there.

Scoring joins the documents' n-grams with the sharded model both ways.  Texts are
packed in blocks of ``BLOCK`` symbols; a block asks each shard (a range of a 48-bit
hash) for its distinct n-grams once, however many texts hold them, the shard
answers with their values, and the answers meet the block again.  What is sent for
a block grows with its distinct n-grams, its texts move once and compressed, and
no task holds more than a block or a shard.

A second score, for texts the model was trained on (``own``), takes n-grams that
occur nowhere else as unseen: else a text would be judged by itself.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, resident, width

N, SYMBOLS = 5, 0x110000
#: Before a text, after it, and what stands for NUL: noncharacters.
BEFORE, AFTER, NUL = 0x10FFFE, 0x10FFFF, 0x10FFFD
#: Symbols of a block, at most; bits of a key and those that name its shard; symbols hashed at once.
BLOCK, KEY, SHARD, STEP = 1 << 23, 48, 8, 1 << 20
TIMES = np.random.default_rng(9).integers(1 << 62, 1 << 63, N + 1, "u8") | np.uint64(1)


def symbols(text: str) -> np.ndarray:
    """Code points with ``N`` marks before and one after them."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    a = np.where(a == 0, np.uint32(NUL), a)
    return np.concatenate([np.full(N, BEFORE, "u4"), a, np.full(1, AFTER, "u4")])


def _key(h: np.ndarray, k: int) -> np.ndarray:
    x = h + TIMES[N : N + 1] * np.uint64(k)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x >> np.uint64(64 - KEY)


def tops(a: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The keys of the n-grams of order ``N`` that end at ``ends``, none of which is among the first ``N`` - 1."""
    out = np.zeros(len(ends), "u8")
    for i in range(0, len(ends), STEP):
        at = ends[i : i + STEP]
        h = np.zeros(len(at), "u8")
        for k in range(N):
            h += a[at - k].astype("u8") * TIMES[k]
        out[i : i + len(at)] = _key(h, N)
    return out


def keys_of(grams: list[str]) -> np.ndarray:
    """Keys of n-grams of any orders."""
    sizes = np.fromiter(map(len, grams), "i8", len(grams))
    out = np.zeros(len(grams), "u8")
    for k in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == k)
        a = np.frombuffer("".join([grams[i] for i in at]).encode("utf-32-le"), "<u4").reshape(-1, k).astype("u8")
        out[at] = _key((a[:, ::-1] * TIMES[:k]).sum(1, dtype="u8"), k)
    return out


class _Blocks:
    """Texts gathered until a block is full; a long text goes on in further blocks."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.parts, self.ids, self.size = [], [], 0

    def add(self, name: int, text: str):
        """Yield whenever the block is full; the caller empties it."""
        a = symbols(text)
        for nth, at in enumerate(range(N - 1, len(a), BLOCK)):
            part = a[at - (N - 1) : at + BLOCK]
            if self.parts and self.size + len(part) > BLOCK:
                yield
                self.clear()
            self.parts.append(part)
            self.ids.append((name, nth, len(part) - (N - 1) - (nth == 0), len(part)))  # the first symbol is a mark, never asked for
            self.size += len(part)


def ends_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of every symbol of a block, and where an n-gram of the text ends."""
    doc = np.repeat(np.arange(len(sizes), dtype="i4"), sizes)
    ends = np.ones(len(doc), bool)
    starts = np.cumsum(sizes) - sizes
    for k in range(N - 1):
        ends[starts + k] = False
    return doc, ends


def distinct(a: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the n-grams of order ``N`` that end at ``at``: the number of each, and the distinct ones as rows of symbols."""
    top = tops(a, at)
    code, found = pd.factorize(top)
    del top
    code = code.astype("i4")
    first = np.zeros(len(found), "i8")
    first[code[::-1]] = at[::-1]
    return code, a[first[:, None] + np.arange(1 - N, 1)]


def all_orders(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys of the n-grams and of all their endings, and the places of those of order 1, 2, ... among them."""
    h, each = np.zeros(len(grams), "u8"), []
    for k in range(N):
        h += grams[:, N - 1 - k].astype("u8") * TIMES[k]
        each.append(_key(h, k + 1))
    known = np.unique(np.concatenate(each)) if len(grams) else np.zeros(0, "u8")
    return known, np.array([np.searchsorted(known, x) for x in each])


def _texts(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(t.alias("t"), F.xxhash64(t).alias("h")).where("t <> ''")


def count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(g, c) of every n-gram of order ``N`` in all texts."""

    def run(batches):
        resident("quality")
        held = _Blocks()

        def close():
            a = np.concatenate(held.parts)
            _, ends = ends_of(np.array([len(p) for p in held.parts]))
            code, found = distinct(a, np.flatnonzero(ends & (a != BEFORE)).astype("i4"))
            n = np.bincount(code, minlength=len(found))
            for i in range(0, len(found), 100_000):
                grams = np.ascontiguousarray(found[i : i + 100_000]).view(f"<U{N}")[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(grams.tolist(), pa.string()), pa.array(n[i : i + 100_000], pa.int64())], ["g", "c"])

        for batch in batches:
            for h, t in zip(batch.column("h"), batch.column("t"), strict=True):
                for _ in held.add(h.as_py(), t.as_py()):
                    yield from close()
        if held.parts:
            yield from close()

    return _texts(docs, text).mapInArrow(run, "g string, c long").groupBy("g").agg(F.sum("c").alias("c"))


def train(docs: DataFrame, discounts, text: str = "text") -> tuple[DataFrame, float]:
    """(g, v, r): value and occurrences of every n-gram of all orders; and the log probability of a symbol never seen."""
    levels = [cut(count(docs, text).withColumn("r", F.col("c")), f"order-{N}")]
    for k in range(N, 1, -1):
        up = levels[-1]
        levels.append(cut(up.groupBy(F.substring("g", 2, k - 1).alias("g")).agg(F.count("*").alias("c"), F.sum("r").alias("r")), f"order-{k - 1}"))
    parts, lower, base = [], None, -math.log(SYMBOLS)
    for k, table in enumerate(reversed(levels), 1):
        d1, d2, d3 = discounts(table)
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        rows = table.select("g", "r", F.col("c").cast("double").alias("c"), off.alias("off"), F.substring("g", 1, k - 1).alias("ctx"), F.substring("g", 2, k - 1).alias("low"))
        if k == 1:
            total, freed = rows.agg(F.sum("c"), F.sum("off")).first()
            if not total:
                break
            base = math.log(freed / total / SYMBOLS)
            p = (F.col("c") - F.col("off")) / total + math.exp(base)
            lower = rows.select("g", "r", p.alias("p"), (F.log(p) - base).alias("v"))
        else:
            totals = rows.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("off").alias("freed")).select("ctx", "total", (F.col("freed") / F.col("total")).alias("gamma"))
            totals = cut(totals, f"contexts-{k}")
            parts.append(totals.select(F.col("ctx").alias("g"), F.log("gamma").alias("v"), F.lit(None).cast("long").alias("r")))
            both = rows.join(totals, "ctx").join(lower.select(F.col("g").alias("low"), F.col("p").alias("q")), "low")
            p = (F.col("c") - F.col("off")) / F.col("total") + F.col("gamma") * F.col("q")
            lower = both.select("g", "r", p.alias("p"), (F.log(p) - F.log("gamma") - F.log("q")).alias("v"))
        lower = cut(lower, f"values-{k}")
        parts.append(lower.select("g", "v", "r"))
    if not parts:
        return levels[0].select("g", F.lit(0.0).alias("v"), "r"), base
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return cut(out.groupBy("g").agg(F.sum("v").alias("v"), F.max("r").alias("r")), "model"), base


def _planes(x: np.ndarray, n: int) -> bytes:
    """The ``n`` lower bytes of little-endian numbers, byte by byte."""
    return np.ascontiguousarray(x.view("u1").reshape(len(x), -1)[:, :n].T).tobytes()


def _numbers(raw: bytes, at: int, n: int, width_: int, kind: str) -> np.ndarray:
    """``n`` numbers of a kind from their ``width_`` lower bytes, which begin at ``at``."""
    out = np.zeros((n, np.dtype(kind).itemsize), "u1")
    out[:, :width_] = np.frombuffer(raw, "u1", n * width_, at).reshape(width_, n).T
    return out.view(kind)[:, 0]


LOW = KEY - SHARD
#: Occurrences are sent back up to this many; a block holds fewer.
MOST = (1 << 24) - 1


def pack(known: np.ndarray, squeeze) -> list[tuple[int, bytes]]:
    """(shard, bytes) of the sorted keys a block asks for."""
    bounds = np.searchsorted(known, np.arange((1 << SHARD) + 1, dtype="u8") << np.uint64(LOW)).tolist()
    low = known & np.uint64((1 << LOW) - 1)
    return [(s, squeeze(_planes(np.diff(low[a:b], prepend=np.uint64(0)), LOW // 8))) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if a < b]


def unpack(raw: bytes) -> np.ndarray:
    """The keys of one shard, without the bits that name it."""
    return np.cumsum(_numbers(raw, 0, len(raw) // (LOW // 8), LOW // 8, "u8"), dtype="u8")


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """(block, ids, data): texts by blocks, compressed."""

    def run(batches):
        resident("quality")
        squeeze = zstandard.ZstdCompressor(level=5).compress
        held, made, task = _Blocks(), 0, TaskContext.get().partitionId()

        def close():
            nonlocal made
            whole = np.concatenate(held.parts).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            block, made = task << 32 | made, made + 1
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.array(held.ids, "i8").tobytes()], pa.binary()), pa.array([squeeze(whole)], pa.binary())], ["block", "ids", "data"])

        for batch in batches:
            for h, t in zip(batch.column("h"), batch.column("t"), strict=True):
                for _ in held.add(h.as_py(), t.as_py()):
                    yield close()
        if held.parts:
            yield close()

    return _texts(docs, text).mapInArrow(run, "block long, ids binary, data binary")


def _opened(ids: bytes, data: bytes) -> tuple[np.ndarray, ...]:
    """The names of a block's texts, the text of every n-gram, the number of each, and the distinct ones."""
    ids = np.frombuffer(ids, "i8").reshape(-1, 4)
    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    doc, ends = ends_of(ids[:, 3])
    at = np.flatnonzero(ends).astype("i4")
    return ids, doc[at], *distinct(a, at)


def _asked(packed: DataFrame) -> DataFrame:
    """(shard, block, data): the distinct n-grams of all orders that a block asks a shard for (kind 1)."""

    def run(batches):
        resident("quality")
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for block, ids, data in zip(*(batch.column(c) for c in ("block", "ids", "data")), strict=True):
                known, _ = all_orders(_opened(ids.as_py(), data.as_py())[3])
                shards, rows = zip(*pack(known, squeeze), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([1] * len(rows), pa.int32()), pa.array([block.as_py()] * len(rows), pa.int64()), pa.array(rows, pa.binary())], ["shard", "kind", "block", "data"])

    return packed.mapInArrow(run, "shard int, kind int, block long, data binary")


def _shards(model: DataFrame) -> DataFrame:
    """The model's rows packed by shard (kind 0)."""

    def run(batches):
        for batch in batches:
            key = keys_of(batch.column("g").to_pylist())
            v, r = batch.column("v").to_numpy(), batch.column("r").fill_null(MOST).to_numpy()
            shard = key >> np.uint64(LOW)
            order = np.argsort(shard, kind="stable")
            bounds = np.searchsorted(shard[order], np.arange((1 << SHARD) + 1, dtype="u8")).tolist()
            got = [(s, order[a:b]) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if a < b]
            data = [(key[i] & np.uint64((1 << LOW) - 1)).tobytes() + v[i].astype("f8").tobytes() + r[i].astype("i8").tobytes() for _, i in got]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in got], pa.int32()), pa.array([0] * len(got), pa.int32()), pa.array([0] * len(got), pa.int64()), pa.array(data, pa.binary())], ["shard", "kind", "block", "data"])

    return model.select("g", "v", "r").mapInArrow(run, "shard int, kind int, block long, data binary")


def _answered(rows: DataFrame) -> DataFrame:
    """(block, shard, data): for each n-gram asked for its value (0 if the model lacks it) and occurrences; rows of a shard come model first."""

    def run(batches):
        resident("quality")
        open_, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        last, parts, table = None, [], None
        for batch in batches:
            out = []
            for shard, kind, block, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "block", "data")), strict=True):
                if shard != last:
                    last, parts, table = shard, [], None
                if kind == 0:
                    parts.append(np.frombuffer(data, "u8").reshape(3, -1))
                    continue
                if table is None:
                    key, v, r = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), "u8")
                    order = np.argsort(key)
                    table, parts = (np.append(key[order], np.uint64(1 << 63)), np.append(v[order].view("f8"), 0.0).astype("f4"), np.append(np.minimum(r[order].view("i8"), MOST), 0).astype("u4")), []
                key = unpack(open_(data))
                at = np.searchsorted(table[0], key)
                at[table[0][at] != key] = len(table[0]) - 1
                out.append((block, shard, squeeze(_planes(table[1][at], 4) + _planes(table[2][at], 3))))
            if out:
                blocks, shards, answers = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(shards, pa.int32()), pa.array(answers, pa.binary())], ["block", "shard", "data"])

    return rows.mapInArrow(run, "block long, shard int, data binary")


def block_scores(ids: bytes, data: bytes, answers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a block with the sums of their log probabilities, of both kinds; ``answers`` in the order of shards."""
    ids, doc, code, grams = _opened(ids, data)
    known, place = all_orders(grams)
    got = [(_numbers(x, 0, len(x) // 7, 4, "f4"), _numbers(x, 4 * (len(x) // 7), len(x) // 7, 3, "u4")) for x in map(zstandard.ZstdDecompressor().decompress, answers)]
    value, seen = (np.concatenate(x) for x in zip(*got, strict=True))
    if len(value) != len(known):
        raise RuntimeError("a block's answers are not those it asked for")
    value = value.astype("f8")
    whole, score, lost = value[place].sum(0), np.zeros(len(ids)), np.zeros(len(ids))
    often = np.zeros(len(grams))
    for i in range(0, len(code), STEP):
        part = code[i : i + STEP]
        score += np.bincount(doc[i : i + STEP], whole[part], len(ids))
        often += np.bincount(part, minlength=len(grams))
    for at in place:  # an n-gram none of whose occurrences lie outside the block may be held by one text only
        rare = (np.bincount(at, often, len(known)) >= seen) & (seen > 0)
        mine = np.flatnonzero(rare[at][code])
        pairs, n = np.unique(doc[mine].astype("i8") << 32 | at[code[mine]], return_counts=True)
        holder, key = pairs >> 32, pairs & 0xFFFFFFFF
        alone = n >= seen[key]
        lost += np.bincount(holder[alone], (value[key] * n)[alone], len(ids))
    return ids, score, score - lost


def surprise(docs: DataFrame, model: DataFrame, base: float, text: str = "text") -> DataFrame:
    """(h, s, own) for every distinct text that is not empty: its xxhash64 and mean negative log probabilities."""
    packed = _packed(docs, text).repartition(width(docs), "block")  # asked and scored: the exchange is used twice
    asked = _shards(model).union(_asked(packed)).repartition(width(docs), "shard").sortWithinPartitions("shard", "kind", "block")
    answers = _answered(asked)

    def add_up(blocks: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for ids, data in zip(blocks.column("ids"), blocks.column("data"), strict=True):
            named, score, own = block_scores(ids.as_py(), data.as_py(), found.sort_by("shard").column("data").to_pylist())
            out.append((named[:, 0], named[:, 1], named[:, 2], score, own))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["h", "nth", "n", "s", "own"])

    scored = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, "h long, nth long, n long, s double, own double")
    parts = scored.groupBy("h", "nth").agg(*[F.max(c).alias(c) for c in ("n", "s", "own")])
    return parts.groupBy("h").agg(*[(-F.sum(c) / F.sum("n") - base).alias(c) for c in ("s", "own")])

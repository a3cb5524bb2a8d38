"""Byte-level BPE by merge replay over an inverted index of token pairs.

The distinct words of a block of the corpus lie side by side in one array of
symbols.  An index maps each pair of neighbouring tokens to the positions where
it occurs; a heap hands out pairs by the rank of their merged token, and each
merge visits only its own positions and the neighbours it touches.  One replay
thus tokenizes all words of a block at once.

Ranks can, in principle, ask for an earlier rank after a later one inside one
word.  The replay notices (a new pair ranks below the merge at hand) and encodes
such words by the definition itself, so ids are exact for any rank file.

A task works on blocks of bounded text and keeps a bounded table of words it has
replayed; nothing is shuffled, and a lost executor repeats only its own blocks.

Null text counts as empty; an empty text has no ids and the digest of no bytes.
Repeated rows give repeated results; further columns pass through untouched
unless they bear the names of the results, which replace them.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import resident

#: Characters of text in a block, and words kept between blocks.
BLOCK_CHARS, CACHE_WORDS = 2_000_000, 800_000
#: A pair of ids as one number.
SHIFT = 24
MASK = (1 << SHIFT) - 1


def parse_ranks(lines) -> dict[bytes, int]:
    """token bytes -> rank, from lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file that every machine has (it comes with the tokenizer package)."""
    with open(path, "rb") as f:
        return parse_ranks(f)


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word by definition: merge the leftmost pair of least rank until none is left."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(((ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1)))
        if best[0] == 1 << 62:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class MergeReplay:
    """Replays the merges of a rank file over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.first = np.array([*(ranks.get(bytes([i]), -1) for i in range(256)), -1], "i4")
        #: Rank of every pair of bytes, -1 if they don't merge; 256 stands for no byte.
        self.byte_pairs = np.full((257, 257), -1, "i4")
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0], token[1]] = rank
        self.pairs: dict[int, int] = {}  # code of a pair of ids -> id of the merged token, -1 if none

    def merged(self, code: int) -> int:
        got = self.pairs[code] = self.ranks.get(self.bytes_of[code >> SHIFT] + self.bytes_of[code & MASK], -1)
        return got

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        if len(self.pairs) > 300_000:
            self.pairs.clear()
        out: list[list[int]] = [[]] * len(words)
        owner: list[int] = []
        for w, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[w] = [whole]
            elif word:
                owner.append(w)
        if not owner:
            return out
        # symbols of all words side by side, -1 before, between and after them; -2 later marks merged-away places
        size = np.fromiter((len(words[w]) for w in owner), "i8", len(owner))
        starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) + 1
        n = int(size.sum() + len(owner) + 1)
        flat = np.frombuffer(b"".join([words[w] for w in owner]), "u1")
        symbol = np.full(n, 256, "i4")
        symbol[np.arange(len(flat)) + np.repeat(np.arange(1, len(owner) + 1), size)] = flat
        tok: list[int] = self.first[symbol].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_at = self.byte_pairs[symbol[:-1], symbol[1:]]
        places = np.flatnonzero(rank_at >= 0)
        places = places[np.argsort(rank_at[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank_at[places])) + 1
        merged, ranked = self.merged, self.pairs
        index: dict[int, list[int]] = {}  # pair code -> places, only for pairs that merge
        for run in np.split(places, cuts):
            if len(run):
                code = tok[run[0]] << SHIFT | tok[run[0] + 1]
                merged(code)
                index[code] = run.tolist()
        heap = [(ranked[code], code) for code in index]
        heapq.heapify(heap)
        broken: set[int] = set()  # places whose word saw a rank below the merge at hand
        while heap:
            rank, code = heapq.heappop(heap)
            places = index.pop(code, None)
            if not places:
                continue
            a, b = code >> SHIFT, code & MASK
            if a == b:  # only then can occurrences overlap
                places.sort()
            for i in places:
                if tok[i] != a:
                    continue
                j = nxt[i]
                if tok[j] != b:
                    continue
                k = nxt[j]
                tok[i], tok[j] = rank, -2
                nxt[i] = k
                prv[k] = i
                h = prv[i]
                right, left = tok[k], tok[h]
                if right >= 0:
                    new = rank << SHIFT | right
                    r = ranked.get(new)
                    if r is None:
                        r = merged(new)
                    if r >= 0:
                        at = index.get(new)
                        if at is None:
                            index[new] = [i]
                            heapq.heappush(heap, (r, new))
                        else:
                            at.append(i)
                        if r < rank:
                            broken.add(i)
                if left >= 0:
                    new = left << SHIFT | rank
                    r = ranked.get(new)
                    if r is None:
                        r = merged(new)
                    if r >= 0:
                        at = index.get(new)
                        if at is None:
                            index[new] = [h]
                            heapq.heappush(heap, (r, new))
                        else:
                            at.append(h)
                        if r < rank:
                            broken.add(i)
        left_over = np.array(tok, "i4")
        live = left_over >= 0
        ends = np.cumsum(np.add.reduceat(live, starts - 1, dtype="i8")).tolist()
        ids = left_over[live].tolist()
        redo = set((np.searchsorted(starts, sorted(broken), "right") - 1).tolist()) if broken else ()
        for s, (w, i, j) in enumerate(zip(owner, [0, *ends], ends, strict=False)):
            out[w] = encode_word(words[w], self.ranks) if s in redo else ids[i:j]
        return out


class Tokenizer:
    """Splits texts, encodes each distinct new word once, and keeps a bounded table of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_words: int = CACHE_WORDS):
        self.replay, self.pattern, self.most = MergeReplay(ranks), regex.compile(pattern), cache_words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        for b, i in ranks.items():
            self.token[i] = b

    def learn(self, words: set[str]) -> None:
        """Have every word in ``known``; words not met for a generation are forgotten."""
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        new = words - self.known.keys()
        for w in new & self.older.keys():
            self.known[w] = self.older[w]
        new = list(new - self.known.keys())
        gc.disable()  # the replay makes many short lists and no cycles: looking for cycles among them takes a tenth of its time
        try:
            ids = self.replay.encode([w.encode("utf-8", "surrogatepass") for w in new])
        finally:
            gc.enable()
        sizes = np.cumsum([len(x) * 4 for x in ids]).tolist()
        flat = np.fromiter(chain.from_iterable(ids), "<u4", sizes[-1] // 4 if sizes else 0).tobytes()
        self.known.update(zip(new, [flat[i:j] for i, j in zip([0, *sizes], sizes, strict=False)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def tokenizer(path: str, pattern: str, cache_words: int) -> Tokenizer:
    """One per worker process, so later tasks know the words of earlier ones."""
    return resident(("bpe", path, pattern, cache_words), lambda: Tokenizer(load_ranks(path), pattern, cache_words))


RESULTS = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``keep`` columns with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``ids``.

    ``rank_file`` is a path that exists on every machine, or the name of a file
    given to ``SparkContext.addFile``.  ``cache_words`` bounds what a worker
    remembers, at some 250 bytes a word; fewer words cost time, not results.
    """
    keep = tuple(k for k in keep if k not in {x for x, _ in RESULTS} | {"ids"})
    rows = docs.select(*[docs[k] for k in keep], F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    more = RESULTS + ([("ids", T.ArrayType(T.IntegerType(), False))] if with_ids else [])
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField(n, t, False) for n, t in more])

    def run(batches):
        import os

        path = rank_file if os.path.exists(rank_file) else SparkFiles.get(os.path.basename(rank_file))
        tok = tokenizer(path, pattern, cache_words)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            at, col = 0, batch.column("_text")
            sizes = pa.compute.utf8_length(col).to_pylist()
            while at < len(sizes):
                end, size = at, 0
                while end < len(sizes) and (end == at or size + sizes[end] <= BLOCK_CHARS):
                    size += sizes[end]
                    end += 1
                part = batch.slice(at, end - at)
                ids = tok.encode(part.column("_text").to_pylist())
                back = [tok.decode(x) for x in ids]
                arrays = [part.column(k) for k in keep] + [
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array(map(sha, back), pa.string()),
                ]
                if with_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("i4")
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<u4").astype("i4"))))
                yield pa.RecordBatch.from_arrays(arrays, [*keep, *(n for n, _ in more)])
                at = end

    return rows.mapInArrow(run, schema)

"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on the words of all ordinary training
text, one on the words that mark toxic text (those holding character n-grams far
more frequent there than in ordinary text; most words of toxic text are as
ordinary as any, and a dictionary of all of them tells little).  A window - a word, or a piece
of a very long one, echoed a few times so that the fixed costs of a frame vanish
- is compressed with each.  The pair of lengths, beside the window's own, falls
into a cell; a cell's weight is the log ratio of its frequencies in toxic and in
ordinary training text.  A document's evidence, the sum of the weights above a
threshold, as such and for each word, becomes a probability by a logistic curve
fitted on the training documents.

Training uses a bounded sample of labelled documents (``MOST_TOXIC``,
``MOST_ORDINARY`` and ``MOST_CHARS``, chosen by hash of the id), all words of them;
scoring reads every text whole.
Null texts are empty and score like any text without evidence.  Without labels
of both kinds every score is the share of toxic labels (0 if there are none).
Rows whose doc_id is null are never learned from.  Repeated labels count once;
contradictory ones count as toxic.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, resident

#: Labelled documents used for training, at most.
MOST_TOXIC, MOST_ORDINARY = 1000, 3000
#: Of either label, documents are taken until their texts have so many characters together.
MOST_CHARS = 40_000_000
GRAM, LONGEST, ECHO, LEVEL, WINDOW = 5, 10, 4, 6, 64
ORDINARY_BYTES, TOXIC_BYTES = 32768, 8192
#: A word counts so often, at most, when a dictionary is trained.
OFTEN = 20
#: Weights from which a cell counts as evidence.
LEAST_WEIGHT, STRONG = 1.5, 4.0
#: A marking n-gram is so many times as frequent in toxic text; so many occurrences count from one document.
RATIO, EACH = 25, 8
#: Least share of the toxic documents (three at least) that a marking n-gram occurs in.
SPREAD = 0.008
CACHE = 400_000
STRIP = bytes.maketrans(b".,;:!?|\"()*%&$#'", b" " * 16)


def windows(text: str) -> list[bytes]:
    """Lower-cased words without punctuation, long ones in pieces."""
    found = text.lower().encode("utf-8", "surrogatepass").translate(STRIP).split()
    if any(len(w) > WINDOW for w in found):
        return [w[i : i + WINDOW] for w in found for i in range(0, len(w), WINDOW)]
    return found


def _grams(word: bytes) -> list[bytes]:
    """The n-grams of a word with its ends, and its longer beginnings."""
    x = b" " + word + b" "
    return [x[i : i + GRAM] for i in range(len(x) - GRAM + 1)] + [x[:k] for k in range(GRAM + 1, min(len(x), LONGEST) + 1)]


def _dictionary(seen: Counter, size: int, together: int) -> bytes:
    """A dictionary trained on words by how often they occur (``OFTEN`` times at most), some of them together.

    Where there are too few for zstandard to train on, the dictionary is the words themselves, the rarest first.
    """
    words = [w for w, c in sorted(seen.items()) for _ in range(min(c, OFTEN))]
    np.random.default_rng(0).shuffle(words)
    samples = [b" " + b" ".join(words[i : i + together]) for i in range(0, len(words), together)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(w for w, _ in sorted(seen.items(), key=lambda x: (x[1], x[0])))[-size:]


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    weights: dict
    slopes: tuple
    offset: float

    def key(self) -> str:
        return hashlib.sha1(repr((self.ordinary, self.toxic, self.slopes, self.offset)).encode()).hexdigest()


class Cells:
    """The cell of a window, remembered for a bounded number of windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        made = [zstandard.ZstdCompressionDict(d or b" ") for d in (ordinary, toxic)]
        for d in made:
            d.precompute_compress(level=LEVEL)
        self.packers = [zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False) for d in made]
        self.known: dict[bytes, tuple] = {}

    def of(self, word: bytes) -> tuple[int, int, int]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            x = (b" " + word) * ECHO + b" "
            got = self.known[word] = (min(len(word), 12), len(self.packers[0].compress(x)), len(self.packers[1].compress(x)))
        return got


def evidence(words: list[bytes], cells: Cells, weights: dict) -> tuple[float, ...]:
    """What speaks for toxicity: the sum of all and of strong weights, in itself and for each word, as logarithms."""
    of, get = cells.of, weights.get
    found = [x for x in [get(of(w)) for w in words] if x is not None]
    total, strong = sum(found), sum([x for x in found if x > STRONG])
    return math.log1p(total), math.log((total + 0.5) / (len(words) + 20)), math.log1p(strong), math.log((strong + 0.5) / (len(words) + 20))


def _apart(split: list[tuple[list[bytes], int]]) -> list[tuple[list[bytes], int]]:
    """Without near copies: what a group of copies shares would pass for a mark of its label.

    Two texts of one label count as copies if the least or the greatest hash of their word triples agrees.
    """
    seen: set[tuple] = set()
    out = []
    for words, y in split:
        hashes = {zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))}
        keys = {(y, 0, min(hashes)), (y, 1, max(hashes))}
        if not keys & seen:
            out.append((words, y))
        seen |= keys
    return out


def fit(texts: list[tuple[str, int]]) -> Model:
    """Train on (text, 1 if toxic else 0)."""
    split = _apart([(windows(t), y) for t, y in texts])
    n = [sum(y == k for _, y in split) for k in (0, 1)]
    if not all(n):
        share = n[1] / max(1, sum(n))
        return Model(b"", b"", {}, (), math.log((share or 1e-9) / (1 - share or 1e-9)))
    labels = [y for _, y in split]
    size = [sum(len(w) for w, y in split if y == k) + 1 for k in (0, 1)]
    counted = [Counter(w) for w, _ in split]
    spread: Counter = Counter()
    sums, words = (Counter(), Counter()), (Counter(), Counter())
    for c, y in zip(counted, labels, strict=True):
        words[y].update(c)
        mine: Counter = Counter()
        for w, k in c.items():
            for g in set(_grams(w)):
                mine[g] += k
        sums[y].update({g: min(k, EACH) for g, k in mine.items()})
        if y:
            spread.update(mine.keys())
    marks = {g for g, k in sums[1].items() if spread[g] >= max(3, SPREAD * n[1]) and k / size[1] > RATIO * (sums[0][g] + 1) / size[0]}
    marking = Counter({w: k for w, k in words[1].items() if (grams := _grams(w)) and sum(g in marks for g in grams) >= min(2, len(grams))})
    ordinary_dict, toxic_dict = _dictionary(words[0], ORDINARY_BYTES, 8), _dictionary(marking, TOXIC_BYTES, 4)
    cells = Cells(ordinary_dict, toxic_dict)
    have = (Counter(), Counter())
    for c, y in zip(counted, labels, strict=True):
        mine = Counter()
        for w, k in c.items():
            mine[cells.of(w)] += k
        have[y].update({g: min(k, EACH) for g, k in mine.items()})
    weights = {
        k: w for k in have[1]
        if have[1][k] >= 3 and (w := math.log((have[1][k] + 0.5) / size[1] / ((have[0][k] + 0.5) / size[0]))) > LEAST_WEIGHT
    }
    x = np.array([evidence(words, cells, weights) for words, _ in split])
    return Model(ordinary_dict, toxic_dict, weights, *_logistic(x, np.array(labels, float)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[tuple[float, ...], float]:
    """Slopes and offset by Newton's method, with a small penalty on the slopes."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([*[penalty] * (x.shape[1] - 1), 1e-6])
    a = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ a)
        a -= step * min(1.0, 5 / max(1e-12, abs(step).max()))
        if abs(step).max() < 1e-9:
            break
    return tuple(map(float, a[:-1])), float(a[-1])


def score_texts(texts: Iterable[str], model: Model) -> list[float]:
    """Probability that each text is toxic."""
    cells = resident(("toxicity", model.key()), lambda: Cells(model.ordinary, model.toxic))
    out = []
    for t in texts:
        z = model.offset
        if model.slopes:
            z += sum(a * x for a, x in zip(model.slopes, evidence(windows(t), cells, model.weights), strict=True))
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return out


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the labelled documents that aren't held out."""
    known = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc))).groupBy(F.col(doc).alias("_id")).agg(F.max(label).alias("_y"))
    pick = lambda y, most: known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most)
    chosen = F.broadcast(pick(1, MOST_TOXIC).union(pick(0, MOST_ORDINARY)))  # at most 4,000 rows of two numbers
    rows = docs.join(chosen, docs[doc] == chosen["_id"]).select("_id", F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"), "_y")
    rows = cut(rows.withColumn("n", F.length("t").cast("long")), "labelled")
    before = F.sum("n").over(Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id", F.xxhash64("t")).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < MOST_CHARS).select("_id", "t", "_y").collect()
    return fit([(r["t"], int(r["_y"])) for r in sorted(rows, key=lambda r: (r["_id"], r["t"]))])


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted``."""
    rows = docs.select(*[docs[k] for k in keep], F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    schema = T.StructType([*[rows.schema[k] for k in keep], T.StructField("score", T.DoubleType(), False)])

    def run(batches):
        for batch in batches:
            scores = score_texts((t.as_py() for t in batch.column("_text")), model)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(scores, pa.float64())], schema.names)

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

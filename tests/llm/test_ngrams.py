"""The growing n-gram model against dictionaries, and on scripts that one symbol used to stand for."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from detlake.llm import ngrams, quality
from tests.llm.test_llm import docs, words

N, BEFORE, AFTER = ngrams.N, chr(ngrams.BEFORE), chr(ngrams.AFTER)


def plain(texts):
    """Surprise of a text, and of a trusted one without the n-grams only it has."""
    grams = lambda t: [(BEFORE * (N - 1) + t + AFTER)[i : i + N] for i in range(len(t) + 1)]
    levels = {N: Counter(g for t in texts for g in grams(t))}
    for k in range(N - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    model, full = {}, {k: Counter(g[N - k :] for t in texts for g in grams(t)) for k in range(1, N + 1)}
    for k, c in levels.items():
        n = [0, *(sum(v == j for v in c.values()) for j in (1, 2, 3, 4))]
        y = n[1] / max(1, n[1] + 2 * n[2])
        d = [0, *(min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[j] else 0, .05), j) for j in (1, 2, 3))]
        total, freed = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            freed[g[:-1]] += d[min(v, 3)]
        model[k] = (c, d, total, freed)

    def p(g, known):
        if not g:
            return 1 / ngrams.SYMBOLS
        c, d, total, freed = model[len(g)]
        low, ctx = p(g[1:], known), g[:-1]
        if not total[ctx] or (ctx.strip(BEFORE) and not known(ctx)):
            return low
        share = freed[ctx] / total[ctx] * low
        if not c[g] or not known(g):
            return share
        return (c[g] - d[min(c[g], 3)]) / total[ctx] + share

    def surprise(t, own=False):
        mine = {k: Counter(g[N - k :] for g in grams(t)) for k in range(1, N + 1)}
        known = lambda g: not own or mine[len(g)][g] < full[len(g)][g]
        return -sum(math.log(p(g, known)) for g in grams(t)) / (len(t) + 1)

    return surprise


def test_long_texts_go_on_in_further_blocks(monkeypatch):
    def ends(block):
        monkeypatch.setattr(ngrams, "BLOCK", block)
        held, found, asked = ngrams._Blocks(), Counter(), 0

        def take():
            a = np.concatenate(held.parts)
            doc, ends = ngrams.ends_of(np.array([len(p) for p in held.parts]))
            at = np.flatnonzero(ends)
            code, grams = ngrams.distinct(a, at)
            known, place = ngrams.all_orders(grams)
            for k in place:
                found.update((held.ids[d][0], x) for d, x in zip(doc[at].tolist(), known[k][code].tolist()))
            return sum(n for _, _, n, _ in held.ids)

        for i, t in enumerate([words(40), "", "x" * 49, words(9, 1), "漢"]):
            for _ in held.add(i, t):
                asked += take()
        return found, asked + take()

    assert ends(1 << 20) == ends(50) == ends(7)


def test_against_dictionaries(spark):
    texts = [words(30, i).replace("1", "é") + ". Ok,\n" for i in range(6)] + ["漢字かな交じり文です。", "AB\0C 😀"]
    asked = [*texts[:2], "ZZZ!! QQQ!!", "neu ßä 漢字 x", "a", "漢字かな", texts[0]]
    model, base = ngrams.train(docs(spark, list(enumerate(texts))), quality._discounts)
    want = plain([t.replace("\0", chr(ngrams.NUL)) for t in texts])
    for these, own in ((asked, False), (texts, True)):
        d = docs(spark, list(enumerate(these)))
        got = {r["doc_id"]: r["s"] for r in quality.scored_by(d, ngrams.surprise(d, model, base), "s", score="own" if own else "s").select("doc_id", "s").collect()}
        assert len(got) == len(these) and all(got[i] == pytest.approx(want(t.replace("\0", chr(ngrams.NUL)), own), rel=1e-5) for i, t in enumerate(these))


def test_table_grows_and_tells_scripts_apart(spark):
    rnd = random.Random(3)
    stock = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(2)) for _ in range(60)]
    good = lambda: "".join(rnd.choice(stock) for _ in range(80))
    junk = lambda: "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(160))
    rows = [(i, good(), "zh") for i in range(60)] + [(100 + i, good(), "zh") for i in range(5)] + [(200 + i, junk(), "zh") for i in range(5)]
    d = docs(spark, rows)
    found = {r["doc_id"]: r["__surprise"] for r in quality.classify(d, d.where("doc_id < 60")).collect()}
    assert max(found[100 + i] for i in range(5)) + 1 < min(found[200 + i] for i in range(5))
    kept = {r["doc_id"] for r in quality.classify(d, d.where("doc_id < 60")).where(F.col("__keep")).select("doc_id").collect()}
    assert not {200 + i for i in range(5)} & kept and len(kept & set(range(60))) >= 58
    sizes = [ngrams.count(d.where(F.col("doc_id").between(200, last))).count() for last in (201, 204)]
    assert sizes[1] > 2 * sizes[0]

"""Nearest neighbours by a robust-pruned directed graph in every shard.

Rows are spread over shards of bounded size by a hash of the vector; each shard
holds its distinct vectors once, however often they occur.  Its graph grows by
greedy searches: every vector is searched from the medoid, what the search
visited becomes its candidates, and robust pruning keeps a candidate unless a
kept one is closer to it by the factor alpha (relaxed distances keep edges that
point apart).  Edges are made both ways and pruned again where a node gets too
many.  A beam search then answers queries in each shard, and the best of all
shards are taken by exact cosine, computed in double precision on the original
vectors.

All steps run on many nodes at once in numpy: a search advances a whole block
of queries by one hop at a time, so its memory is block x beam, whatever the
shard.  Shards and blocks of queries are rows of tables in the shared folder.

Vectors that are null, zero, of another length than the most frequent one or hold
null or non-finite components take no part.  Rows with a null id take no part.
Of rows with one id the least vector counts.  Single-precision vectors stay such,
any others are double; the graph alone is always single.  Ties go to the smaller id.  An index
covers every other row; recall is measured against brute force in the tests.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut

#: Distinct vectors in a shard, about; queries in a block.
SHARD_ROWS, QUERY_BLOCK = 16384, 512
DEGREE, BEAM, ALPHA = 32, 64, 1.2
#: Beam of a query's search.
SEARCH_BEAM = 160


def robust_prune(own: np.ndarray, cand: np.ndarray, dist: np.ndarray, x: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-neighbours (rows x degree, -1 for none) chosen from ``cand`` (rows x c, -1 for none).

    ``dist`` holds the squared distances of the candidates to ``own``.
    """
    n, c = cand.shape
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    alive = (cand >= 0) & (cand != own[:, None])
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    out = np.full((n, degree), -1, "i4")
    vec = x[np.maximum(cand, 0)]
    rows = np.arange(n)
    for k in range(degree):
        first = alive.argmax(1)
        ok = alive[rows, first]
        if not ok.any():
            break
        out[ok, k] = cand[rows[ok], first[ok]]
        chosen = vec[rows, first]
        between = 2 - 2 * np.einsum("ncd,nd->nc", vec, chosen)
        alive &= ~((alpha * between <= dist) & ok[:, None])
        alive[rows, first] = False
        alive &= ok[:, None]
    return out


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int, trail: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest found for each query, and up to ``trail`` expanded nodes."""
    n, size = len(q), len(x)
    beam = min(beam, size)
    ids = np.full((n, beam), -1, "i4")
    dist = np.full((n, beam), np.inf, "f4")
    done = np.ones((n, beam), bool)
    ids[:, 0], dist[:, 0], done[:, 0] = entry, 2 - 2 * q @ x[entry], False
    seen = np.zeros((n, size), bool)
    seen[:, entry] = True
    visited = np.full((n, trail), -1, "i4")
    rows, steps = np.arange(n), 0
    while True:
        open_ = np.where(done, np.inf, dist)
        at = open_.argmin(1)
        live = np.flatnonzero(np.isfinite(open_[rows, at]))
        if not len(live):
            return ids, dist, visited
        node = ids[live, at[live]]
        done[live, at[live]] = True
        if steps < trail:
            visited[live, steps] = node
        steps += 1
        near = graph[node]
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        d = np.where(fresh, 2 - 2 * np.einsum("nkd,nd->nk", x[np.maximum(near, 0)], q[live]), np.inf).astype("f4")
        r, k = np.nonzero(fresh)
        seen[live[r], near[r, k]] = True
        all_ids, all_dist = np.concatenate([ids[live], near], 1), np.concatenate([dist[live], d], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        best = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        dist[live] = np.take_along_axis(all_dist, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1) | ~np.isfinite(dist[live])


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, int]:
    """(graph, entry) over unit vectors ``x``: nodes join in blocks that double in size."""
    n = len(x)
    graph = np.full((n, degree), -1, "i4")
    entry = int((x @ x.mean(0)).argmax()) if n else 0
    order = np.random.default_rng(seed).permutation(n).astype("i4")
    order = np.concatenate([[entry], order[order != entry]]).astype("i4") if n else order
    at = 1
    while at < n:
        block = order[at : at + min(max(at, 32), 512)]
        ids, dist, visited = beam_search(x, graph, entry, x[block], beam, trail=beam)
        peers = block[(np.arange(len(block))[:, None] + 1 + np.arange(min(8, len(block) - 1))) % len(block)] if len(block) > 1 else np.full((1, 0), -1, "i4")
        cand = np.concatenate([ids, visited, peers], 1)
        cand = np.sort(cand, 1)
        d = np.where(cand >= 0, 2 - 2 * np.einsum("nkd,nd->nk", x[np.maximum(cand, 0)], x[block]), np.inf)
        graph[block] = robust_prune(block, cand, d, x, degree, alpha)
        src, slot = np.nonzero(graph[block] >= 0)
        _add_edges(graph, graph[block][src, slot], block[src], x, degree, alpha)
        at += len(block)
    return graph, entry


def _add_edges(graph: np.ndarray, heads: np.ndarray, tails: np.ndarray, x: np.ndarray, degree: int, alpha: float) -> None:
    """Add the edges heads -> tails; a node with too many is pruned again."""
    order = np.lexsort((tails, heads))
    heads, tails = heads[order], tails[order]
    nodes, start, count = np.unique(heads, return_index=True, return_counts=True)
    for lo in range(0, len(nodes), 1024):
        some, s, c = nodes[lo : lo + 1024], start[lo : lo + 1024], np.minimum(count[lo : lo + 1024], 4 * degree)
        new = np.full((len(some), int(c.max())), -1, "i4")
        r, k = np.nonzero(np.arange(new.shape[1]) < c[:, None])
        new[r, k] = tails[s[r] + k]
        cand = np.sort(np.concatenate([graph[some], new], 1), 1)
        d = np.where(cand >= 0, 2 - 2 * np.einsum("nkd,nd->nk", x[np.maximum(cand, 0)], x[some]), np.inf)
        distinct = (cand >= 0) & np.concatenate([np.ones((len(some), 1), bool), cand[:, 1:] != cand[:, :-1]], 1)
        fits = distinct.sum(1) <= degree
        packed = np.where(distinct, cand, -1)
        packed = -np.sort(-packed, 1)[:, :degree]
        graph[some] = np.where(fits[:, None], packed, -1) if fits.all() else np.where(fits[:, None], packed, robust_prune(some, cand, d, x, degree, alpha))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = a.astype("f8"), b.astype("f8")
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def usable(vectors: DataFrame, id_: str, column: str) -> DataFrame:
    """(id, v) of the rows that take part, each id once; v is an array of float where the column is one, else of double."""
    kind = "array<float>" if vectors.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col(column).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(column).cast(kind).alias("v"), fine.alias("ok")).where("ok AND id IS NOT NULL")
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def stored(rows: DataFrame) -> str:
    """How numpy names the components of ``v``."""
    return "<f4" if rows.schema["v"].dataType.simpleString() == "array<float>" else "<f8"


SHARD = "shard int, ids binary, counts binary, vectors binary, graph binary, entry int"


def index(rows: DataFrame, top: int, shards: int) -> DataFrame:
    """One row per shard (0 to ``shards`` - 1, empty ones missing): distinct vectors, their least ``top`` + 1 ids, and the graph."""
    kind, hashed = stored(rows), rows.withColumn("h", F.xxhash64("v"))
    few = Window.partitionBy("h", "v").orderBy("id")
    kept = hashed.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= top + 1).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "id"], kind="stable")
        keys = [v.tobytes() for v in pdf["v"]]
        place: dict[bytes, int] = {}
        which = np.array([place.setdefault(k, len(place)) for k in keys])
        raw = np.frombuffer(b"".join(place), kind).reshape(len(place), -1)
        unit = (raw.astype("f8") / np.sqrt((raw.astype("f8") ** 2).sum(1, keepdims=True))).astype("f4")
        graph, entry = build_graph(unit)
        order = np.lexsort((pdf["id"].to_numpy(), which))
        counts = np.bincount(which, minlength=len(place)).astype("<i4")
        return pd.DataFrame([{"shard": int(pdf["shard"].iloc[0]), "ids": pdf["id"].to_numpy()[order].astype("<i8").tobytes(), "counts": counts.tobytes(), "vectors": raw.tobytes(), "graph": graph.astype("<i4").tobytes(), "entry": entry}])

    return kept.select("shard", "h", "id", "v").groupBy("shard").applyInPandas(build, SHARD)


def search(rows: DataFrame, every: int = 50, top: int = 5, beam: int = SEARCH_BEAM, id_: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` nearest found of each row whose id divides by ``every``."""
    rows = cut(usable(rows, id_, column), "vectors")
    kind = stored(rows)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (usual["n"] if usual else 0))
    n_shards = max(1, -(-rows.count() // SHARD_ROWS))
    shards = cut(index(rows, top, n_shards), "graph-shards")
    queries = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    packed = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("q"))  # about QUERY_BLOCK each
    # the stated query set against all rows, in blocks: every block goes to every shard once
    asked = cut(packed, "query-blocks").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    pairs = asked.repartition(max(1, min(n_shards * blocks, 4096)), "shard", "block").join(shards, "shard").select("q", "ids", "counts", "vectors", "graph", "entry")

    def run(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                counts = np.frombuffer(r.counts, "<i4")
                ids, raw = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.vectors, kind).reshape(len(counts), -1)
                graph = np.frombuffer(r.graph, "<i4").reshape(len(counts), -1)
                unit = (raw.astype("f8") / np.sqrt((raw.astype("f8") ** 2).sum(1, keepdims=True))).astype("f4")
                start = np.concatenate([[0], np.cumsum(counts)])
                qid = np.array([x["id"] for x in r.q], "i8")
                qv = np.array([x["v"] for x in r.q], kind)
                qu = (qv.astype("f8") / np.sqrt((qv.astype("f8") ** 2).sum(1, keepdims=True))).astype("f4")
                found, dist, _ = beam_search(unit, graph, int(r.entry), qu, beam)
                a, b = np.nonzero((found >= 0) & np.isfinite(dist))
                score = cosine(qv[a], raw[found[a, b]])
                node = found[a, b]
                reps = counts[node]
                at = np.repeat(start[node], reps) + (np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps))
                out = pd.DataFrame({"query_id": np.repeat(qid[a], reps), "vec_id": ids[at], "score": np.repeat(score, reps)})
                out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                yield out.groupby("query_id", sort=False).head(top)

    found = pairs.mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", F.col("rank").cast(T.IntegerType()), "vec_id", "score")

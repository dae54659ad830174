"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors are one node. Nodes are dealt to shards of bounded size by a hash; a task builds a shard's graph by
inserting batches: a beam search over the graph so far finds candidates, a diversity rule chooses neighbours, and
links run both ways. Nodes are numbered by falling level, so each layer is a flat array of neighbour numbers over a
prefix of the nodes. Inner products become distances on a sphere by one more coordinate per vector.

Every query meets every shard, in blocks of queries, and the shards' best are merged per query. Scores are inner
products of the original vectors in double precision.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.store import table, written
from hourcast.llm.vectors import usable


class Graph:
    """HNSW over the rows of ``x`` (float32 on a sphere): ``layers[l]`` is an int32 array of neighbours, -1 for none."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray, sizes: list[int], links: int = 16, ef: int = 64) -> Graph:
        """Rows are sorted by falling level; ``sizes[l]`` of them are in layer l."""
        self = cls(x, [np.full((n, links if l else 2 * links), -1, np.int32) for l, n in enumerate(sizes)])
        for layer in range(len(sizes) - 1, -1, -1):
            n, upper = sizes[layer], sizes[layer + 1] if layer + 1 < len(sizes) else 0
            done = min(n, max(256, upper))
            self._insert(layer, 0, done, links, None)
            while done < n:
                batch = np.arange(done, min(n, 2 * done, done + 1024))
                found, sims = self.search(x[batch], ef, down_to=layer, inserted=done)
                self._insert(layer, done, batch[-1] + 1, links, (found, sims))
                done = int(batch[-1]) + 1
        return self

    def _insert(self, layer: int, lo: int, hi: int, links: int, found: tuple[np.ndarray, np.ndarray] | None) -> None:
        x, flat = self.x, self.layers[layer]
        own = np.arange(lo, hi)
        sims = x[lo:hi] @ x[lo:hi].T
        np.fill_diagonal(sims, -np.inf)
        k = min(hi - lo - 1, 4 * links)
        if k > 0:
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            near_sims = np.take_along_axis(sims, near, 1)
            near = near + lo
        else:
            near, near_sims = np.empty((hi - lo, 0), np.int64), np.empty((hi - lo, 0), x.dtype)
        if found is not None:
            near, near_sims = np.concatenate([found[0], near], 1), np.concatenate([found[1], near_sims], 1)
        chosen = self._choose(near, near_sims, links)
        flat[lo:hi, :chosen.shape[1]] = chosen
        p = np.repeat(own, chosen.shape[1])
        c = chosen.ravel()
        p, c = p[c >= 0], c[c >= 0]
        # links back: what a node has and what it gains, the nearest first, thinned by the same rule if too many
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        nodes, begin, gain = np.unique(c, return_index=True, return_counts=True)
        if not len(nodes):
            return
        at = np.arange(len(c)) - np.repeat(begin, gain)
        room = flat.shape[1]
        fresh = np.full((len(nodes), int(gain.max())), -1, np.int64)
        fresh[np.repeat(np.arange(len(nodes)), gain), at] = p
        lists = np.concatenate([flat[nodes].astype(np.int64), fresh], 1)
        for s in range(0, len(nodes), 512):
            part, who = lists[s:s + 512], nodes[s:s + 512]
            part = np.sort(part, axis=1)
            part[:, 1:][part[:, 1:] == part[:, :-1]] = -1
            near_sims = np.einsum("nkd,nd->nk", x[part], x[who])
            near_sims[part < 0] = -np.inf
            flat[who, :] = -1
            kept = self._choose(part, near_sims, room)
            flat[who, :kept.shape[1]] = kept

    def _choose(self, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` diverse neighbours: one is skipped while a nearer choice is nearer to it than the node is;
        skipped ones fill what stays free."""
        wide = min(near.shape[1], 3 * most)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :wide]
        near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
        out = np.full((len(near), min(most, wide)), -1, np.int64)
        for s in range(0, len(near), 512):
            ids, own = near[s:s + 512], sims[s:s + 512]
            valid = np.isfinite(own) & (ids >= 0)
            rows = self.x[ids]
            between = rows @ rows.transpose(0, 2, 1)
            kept = np.zeros(ids.shape, bool)
            for j in range(wide):
                blocked = (kept[:, :j] & (between[:, j, :j] > own[:, j:j + 1])).any(1) if j else np.zeros(len(ids), bool)
                kept[:, j] = valid[:, j] & ~blocked & (kept.sum(1) < most)
            rank = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :out.shape[1]]
            best = np.take_along_axis(ids, rank, 1)
            out[s:s + 512] = np.where(np.take_along_axis(valid, rank, 1), best, -1)
        return out

    def search(self, q: np.ndarray, ef: int, down_to: int = 0, inserted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best nodes found in layer ``down_to`` for each row of q, best first (-1 and -inf for none)."""
        out = []
        for s in range(0, len(q), 256):
            part = q[s:s + 256]
            entry = np.zeros((len(part), 1), np.int64)
            for layer in range(len(self.layers) - 1, down_to, -1):
                entry = self._beam(part, layer, entry, 4, len(self.layers[layer]))[0][:, :1]
            n = len(self.layers[down_to]) if inserted is None else inserted
            out.append(self._beam(part, down_to, entry, ef, n))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def _beam(self, q: np.ndarray, layer: int, entry: np.ndarray, ef: int, n: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        x, flat = self.x, self.layers[layer]
        ids = np.full((len(q), ef), -1, np.int64)
        sims = np.full((len(q), ef), -np.inf, np.float32)
        open_ = np.zeros((len(q), ef), bool)
        seen = np.zeros((len(q), n + 1), bool)  # the last column stands for no neighbour
        seen[:, n] = True
        every = np.arange(len(q))
        ids[:, 0] = entry[:, 0]
        sims[:, 0] = np.einsum("qd,qd->q", x[entry[:, 0]], q)
        open_[:, 0] = True
        seen[every, entry[:, 0]] = True
        while True:
            turn = open_ & (np.cumsum(open_, axis=1) <= wide)
            rows = np.flatnonzero(turn.any(1))
            if not len(rows):
                return ids, sims
            turn = turn[rows]
            first = np.argsort(~turn, axis=1, kind="stable")[:, :wide]
            picked = np.where(np.take_along_axis(turn, first, 1), np.take_along_axis(ids[rows], first, 1), -1)
            open_[rows] &= ~turn
            near = np.where(picked[:, :, None] >= 0, flat[picked], -1).reshape(len(rows), -1)
            near = np.where((near < 0) | (near >= n), n, near)
            near = np.sort(near, axis=1)
            fresh = ~seen[rows[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[rows[:, None], near] = True
            score = np.full(near.shape, -np.inf, np.float32)
            r, c = np.nonzero(fresh)
            score[r, c] = np.einsum("kd,kd->k", x[near[r, c]], q[rows[r]])
            all_ids = np.concatenate([ids[rows], np.where(fresh, near, -1)], 1)
            all_sims = np.concatenate([sims[rows], score], 1)
            all_open = np.concatenate([open_[rows], fresh], 1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            sims[rows] = np.take_along_axis(all_sims, best, 1)
            open_[rows] = np.take_along_axis(all_open, best, 1)


def build_shard(f: pd.DataFrame, links: int = 16, ef: int = 64) -> pd.DataFrame:
    """One row: the shard's vectors, members and layers as flat arrays."""
    f = f.sort_values(["h1", "h2"], kind="stable")
    x = np.stack(f["embedding"]).astype(np.float64)
    chance = (f["h2"].to_numpy().astype(np.uint64) >> np.uint64(11)).astype(np.float64) / 2**53
    level = np.floor(-np.log(np.maximum(chance, 1e-18)) / np.log(links)).astype(int)
    order = np.lexsort((np.arange(len(f)), -level))
    f, x, level = f.iloc[order], x[order], level[order]
    sizes = [int((level >= l).sum()) for l in range(int(level.max()) + 1)]
    scale = np.abs(x).max()
    small = x / scale
    norm = (small * small).sum(1)
    sphere = np.concatenate([small, np.sqrt(np.maximum(0, norm.max() - norm))[:, None]], 1).astype(np.float32)
    graph = Graph.build(sphere, sizes, links, ef)
    ids = f["ids"].tolist()
    return pd.DataFrame({"shard": f["shard"].iloc[:1].tolist(), "dim": [x.shape[1]], "sizes": [sizes], "links": [[l.shape[1] for l in graph.layers]],
                         "layers": [[l.tobytes() for l in graph.layers]], "sphere": [sphere.tobytes()], "vectors": [x.tobytes()],
                         "ids": [np.concatenate(ids).astype(np.int64)], "ends": [np.cumsum([len(i) for i in ids])]})


_BUILT = "shard long, dim int, sizes array<int>, links array<int>, layers array<binary>, sphere binary, vectors binary, ids array<long>, ends array<long>"


def search_shard(index: pd.DataFrame, queries: pd.DataFrame, k: int, ef: int) -> pd.DataFrame:
    """(h1, h2, found): the k best (score, vec_id) of this shard for each query vector, its own class included."""
    if not len(index) or not len(queries):
        return pd.DataFrame({"h1": pd.Series(dtype="int64"), "h2": pd.Series(dtype="int64"), "found": pd.Series(dtype="object")})
    r = index.iloc[0]
    dim, n = int(r["dim"]), len(r["ends"])
    graph = Graph(np.frombuffer(r["sphere"], np.float32).reshape(n, dim + 1), [np.frombuffer(b, np.int32).reshape(-1, w) for b, w in zip(r["layers"], r["links"])])
    x = np.frombuffer(r["vectors"], np.float64).reshape(n, dim)
    ids, ends = np.asarray(r["ids"]), np.asarray(r["ends"])
    q = np.stack(queries["embedding"]).astype(np.float64)
    scaled = (q / np.abs(q).max(1, keepdims=True)).astype(np.float32)
    nodes, _ = graph.search(np.concatenate([scaled, np.zeros((len(q), 1), np.float32)], 1), ef)
    found = []
    for own, row in zip(nodes, q):
        own = own[own >= 0]
        score = x[own] @ row
        own, score = own[np.argsort(-score, kind="stable")], np.sort(score)[::-1]
        rows: list[tuple[float, int]] = []
        for node, s in zip(own, score):
            if len(rows) >= k and s < rows[k - 1][0]:
                break
            rows += [(float(s), int(i)) for i in ids[ends[node - 1] if node else 0:ends[node]]]
        rows.sort(key=lambda t: (-t[0], t[1]))
        found.append([{"down": -s, "vec_id": i} for s, i in rows[:k]])
    return pd.DataFrame({"h1": queries["h1"], "h2": queries["h2"], "found": found})


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, shard_rows: int = 16_384, links: int = 16, ef_build: int = 64, ef_search: int = 160, query_block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for each row whose vec_id is divisible by ``every``.

    Nearness is the inner product, ties go to smaller vec_ids, a query's own row is no candidate. Vectors without
    vec_id, null, zero or with null or non-finite components take no part; vectors of different lengths don't meet.
    A query with fewer than k candidates gets all; a repeated vec_id is one row. Equal vectors are one node that keeps
    its k + 1 smallest vec_ids, which is all that any result can hold.
    """
    rows = usable(vectors.select("vec_id", "embedding")).dropDuplicates(["vec_id"])
    rows = written(rows, "ann-rows")
    place = Window.partitionBy("dim", "h1", "h2").orderBy("vec_id")
    first = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    nodes = first.groupBy("dim", "h1", "h2").agg(F.first("embedding").alias("embedding"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = written(nodes, "ann-nodes")
    count = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}
    shards = {d: -(-n // shard_rows) for d, n in count.items()}
    if not shards:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    n_shards = F.create_map(*[F.lit(v) for kv in shards.items() for v in kv])[F.col("dim")]
    shard = (F.col("dim").cast("long") * (1 << 32) + F.pmod(F.col("h1"), n_shards)).alias("shard")
    index = nodes.select(shard, "h1", "h2", "embedding", "ids").groupBy("shard").applyInPandas(lambda f: build_shard(f, links, ef_build), _BUILT)
    index = written(index, "ann-index")

    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    query = asked.groupBy("dim", "h1", "h2").agg(F.first("embedding").alias("embedding"))
    query = written(query, "ann-queries")
    blocks = max(1, -(-query.count() // query_block))
    block = F.pmod(F.col("h2"), F.lit(blocks)).cast("int").alias("block")
    each = query.select("dim", "h1", "h2", "embedding", block, F.explode(F.sequence(F.lit(0), n_shards - 1)).alias("s"))
    each = each.select((F.col("dim").cast("long") * (1 << 32) + F.col("s")).alias("shard"), "block", "h1", "h2", "embedding")
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = copies.groupBy("shard", "block").cogroup(each.groupBy("shard", "block")).applyInPandas(
        lambda i, q: search_shard(i, q, k + 1, ef_search), "h1 long, h2 long, found array<struct<down:double,vec_id:long>>")
    best = found.groupBy("h1", "h2").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))

    own = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(best, ["h1", "h2"])
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = own.select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.down")).alias("score"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))

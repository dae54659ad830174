"""Tree ensembles of every series at once, from quantile-binned features.

Features become bytes first: one aggregation gives each series its quantile cuts, and the rows are packed into blocks
of bytes that all models and folds share. A tree grows level by level. What a level needs of its rows is the weight
and the target sum left of every cut of every feature in every open node, and the best cut of a node depends on
nothing else, so

* a series whose rows fit a task (``TASK_ROWS``, seven years of hours; ``DRAWN_ROWS`` for random cuts) is grown by its
  own tasks, each of which takes some of a forest's trees, or all rounds of a boosted model;
* a longer series is grown by level jobs: every block sums up its cells (node, feature, bin) in its task, the cells of
  a node meet in one group that is as large as the bins are many, and the chosen cuts go back to the blocks.

Both use the same cuts and the same draws, which are hashes of (tree, row), (tree, node, feature) and (tree, feature):
they do not depend on how rows are dealt out, and a lost task is repeated with the same result.
"""
from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY

KEYS = [KEY, "horizon"]
#: Rows of a series that one task grows trees of (about 3 KB of working memory a row).
TASK_ROWS = 65_536
#: The same for trees of random cuts (about 0.15 KB of working memory a row).
DRAWN_ROWS = 524_288
#: Rows of a block, and rows times trees that grow side by side in a task.
BLOCK_ROWS, SIDE_BY_SIDE = 8_192, 16_000
MAX_BINS = 256
#: Gains that count as none, and as equal (times the scale of what they are differences of).
_TINY, _EQUAL = 1e-10, 1e-10


@dataclass(frozen=True)
class TreeParams:
    """How an ensemble is grown. ``rate`` 0: the mean of independent trees; otherwise boosting of squared errors."""
    trees: int
    depth: int
    min_leaf: int = 1
    rate: float = 0.0
    l2: float = 0.0
    rows: float = 1.0          # share of the rows that a boosted tree sees
    columns: float = 1.0       # share of the features that a tree sees
    growth: str = "level"      # level | leaf (best leaf first, up to ``leaves``) | oblivious (one cut a level)
    leaves: int = 0
    bootstrap: bool = False    # rows weigh a Poisson draw in each tree
    random_cuts: bool = False  # of one random cut a node and feature the best
    parts: int = 1             # tasks that share a forest's trees


def params_of(preset: str, **changes) -> TreeParams:
    return TreeParams(**(C.TREE_PRESETS[preset] | changes))


def task_rows(p: TreeParams) -> int:
    """Rows of a series that one task grows trees of."""
    return DRAWN_ROWS if p.random_cuts and p.growth == "level" else TASK_ROWS


# ---------------------------------------------------------------- draws
def uniform(*parts) -> np.ndarray:
    """Numbers in [0, 1) from a 64-bit hash of integers (arrays broadcast)."""
    x = np.uint64(C.RANDOM_SEED)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / (1 << 53)


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))
_ROW, _COLUMN, _CUT = 1, 2, 3


def row_weights(p: TreeParams, trees: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Weight of each row in each tree, [tree, row]."""
    if p.bootstrap:
        return np.searchsorted(_POISSON, uniform(_ROW, trees[:, None], row[None, :]), "right").astype(float)
    if p.rows < 1:
        return (uniform(_ROW, trees[:, None], row[None, :]) < p.rows).astype(float)
    return np.ones((len(trees), len(row)))


def columns_of(p: TreeParams, trees: np.ndarray, n: int) -> np.ndarray:
    """Which features each tree sees, [tree, feature]."""
    keep = max(1, int(p.columns * n))
    if keep >= n:
        return np.ones((len(trees), n), bool)
    place = np.argsort(np.argsort(uniform(_COLUMN, trees[:, None], np.arange(n)[None, :]), axis=1), axis=1)
    return place < keep


# ---------------------------------------------------------------- cuts
class Cuts:
    """A series' cuts: per feature the distinct quantile values, and the middles between neighbours."""

    def __init__(self, values: list):
        self.values = [np.unique(np.asarray(v, float)) for v in values]
        self.edges = [(v[1:] + v[:-1]) / 2 for v in self.values]

    def bins(self, x: np.ndarray) -> np.ndarray:
        """[row, feature] bytes: how many cuts a value lies above."""
        return np.column_stack([np.searchsorted(e, x[:, j], "left").astype(np.uint8) for j, e in enumerate(self.edges)])

    def thresholds(self, feature, cut, behind, p: TreeParams) -> np.ndarray:
        """The middle between a cut's bin and the next one; for forests, the next one that the node has."""
        return np.array([(self.values[f][c] + self.values[f][c + 1 if p.rate else b]) / 2 for f, c, b in zip(feature, cut, behind)], float)

    def drawn(self, feature: np.ndarray, low: np.ndarray, high: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A random threshold between the values of two bins of a feature, and the last bin below it."""
        at, cut = np.empty(low.shape), np.empty(low.shape, np.int64)
        for j in range(len(self.values)):
            on = feature == j
            v = self.values[j]
            x = v[low[on]] + u[on] * (v[high[on]] - v[low[on]])
            at[on], cut[on] = x, np.searchsorted(v, x, "right") - 1
        return at, cut


def cut_values(rows: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys..., n, values): a series' row count and its features' distinct quantile values, from one aggregation."""
    probs = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, MAX_BINS)])
    values = [F.array_distinct(F.percentile_approx(F.col(c).cast("double"), probs, F.lit(100_000))).alias(f"v{j}") for j, c in enumerate(features)]
    d = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *values)
    return d.select(*keys, "n", F.array(*[f"v{j}" for j in range(len(features))]).alias("values"))


def _key_types(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def binned_blocks(rows: DataFrame, features: list[str], keys: list[str], cuts: DataFrame, position: str = "idx") -> DataFrame:
    """(keys..., blk, row, bins, y): a block's row numbers, feature bytes and targets. ``position`` numbers the rows of
    a series; rows with a null feature or target are left out."""
    d = rows.dropna(subset=[*features, "y"]).select(*keys, F.col(position).cast("long").alias("_row"), F.floor(F.col(position) / BLOCK_ROWS).alias("_blk"), "y", *features)
    heads = d.select(*keys, "_blk").distinct().join(cuts, keys).toDF(*[f"_{k}" for k in keys], "_b", "n", "values")

    def pack(c: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(r):
            return pd.DataFrame(columns=[*keys, "blk", "row", "bins", "y"])
        r = r.sort_values("_row")
        bins = Cuts(c["values"].iloc[0]).bins(r[features].to_numpy(float))
        one = {k: [r[k].iloc[0]] for k in keys}
        return pd.DataFrame(one | {"blk": [int(r["_blk"].iloc[0])], "row": [r["_row"].to_numpy(np.int64).tobytes()], "bins": [bins.tobytes()],
                                   "y": [r["y"].to_numpy(float).tobytes()]})

    left = heads.groupBy(*[f"_{k}" for k in keys], "_b")
    return left.cogroup(d.groupBy(*keys, "_blk")).applyInPandas(pack, f"{_key_types(rows, keys)}, blk long, row binary, bins binary, y binary")


# ---------------------------------------------------------------- one level
def best_leaves(gain: dict[int, float], children: dict[int, tuple[int, int]], leaves: int) -> set[int]:
    """Nodes that splitting the best leaf first, up to ``leaves`` leaves, splits; unknown gains count as none."""
    todo, split = [(-gain.get(0, 0.0), 0)], set()
    while todo and len(split) < leaves - 1:
        worth, node = heapq.heappop(todo)
        if -worth <= _TINY:
            break
        split.add(node)
        for child in children.get(node, ()):
            if gain.get(child, 0.0) > _TINY:
                heapq.heappush(todo, (-gain[child], child))
    return split


class Growing:
    """The nodes of some trees while they grow. Node ids: the roots first, then children in pairs."""

    def __init__(self, n_trees: int):
        self.feature, self.cut, self.threshold = [np.full(n_trees, -1, np.int64)], [np.zeros(n_trees, np.int64)], [np.zeros(n_trees)]
        self.left, self.value, self.cover = [np.full(n_trees, -1, np.int64)], [np.zeros(n_trees)], [np.zeros(n_trees)]
        self.tree, self.path, self.size = [np.arange(n_trees)], [np.ones(n_trees, np.int64)], n_trees
        self.gain: dict[int, float] = {}
        self.children: dict[int, tuple[int, int]] = {}

    def add(self, parents: np.ndarray, tree: np.ndarray, path: np.ndarray) -> np.ndarray:
        """Ids of the two children of each parent, in pairs."""
        n = 2 * len(parents)
        ids = np.arange(self.size, self.size + n)
        for name, fill in (("feature", -1), ("cut", 0), ("left", -1)):
            getattr(self, name).append(np.full(n, fill, np.int64))
        for name in ("threshold", "value", "cover"):
            getattr(self, name).append(np.zeros(n))
        self.tree.append(np.repeat(tree, 2))
        self.path.append(np.column_stack([2 * path, 2 * path + 1]).ravel())
        self.size += n
        return ids

    def flat(self) -> dict[str, np.ndarray]:
        return {k: np.concatenate(getattr(self, k)) for k in ("feature", "cut", "threshold", "left", "value", "cover", "tree", "path")}


def grow(bins: np.ndarray, w: np.ndarray, g: np.ndarray, tree: np.ndarray, trees: np.ndarray, p: TreeParams, cuts: Cuts) -> tuple[dict, np.ndarray]:
    """Trees grown on rows of bytes: a row for each tree it takes part in (``tree`` is its place in ``trees``), with
    its weight and its weight times the target. Returns flat node arrays and each row's leaf.

    Every feature's rows stand in (node, bin) order, so the sums left of all cuts are running sums within segments
    that all features share, and the next level's order is a stable sort by node.
    """
    if p.random_cuts and p.growth == "level":
        return _grow_drawn(bins, w, g, tree, trees, p, cuts)
    m, n_features = bins.shape
    out, leaf, node = Growing(len(trees)), tree.astype(np.int64), tree.astype(np.int64)
    allowed = columns_of(p, trees, n_features)
    column = np.arange(n_features)[:, None]
    order = np.argsort(bins, axis=0, kind="stable").T
    ids = np.arange(len(trees))  # the open nodes; node[row] is a place in it
    flat = out.flat()
    for depth in range(p.depth + 1):
        rows = order[0]
        weight, total = np.bincount(node[rows], w[rows], len(ids)), np.bincount(node[rows], g[rows], len(ids))
        count = np.bincount(node[rows], minlength=len(ids))
        flat["value"][ids], flat["cover"][ids] = total / np.maximum(weight + p.l2, _TINY), weight
        if depth == p.depth:
            break
        may = count >= 2
        if not may.all():  # nodes of one row or none are leaves
            place = np.cumsum(may) - 1
            order = order[may[node[order]]].reshape(n_features, -1)
            rows = order[0]
            node[rows] = place[node[rows]]
            ids, weight, total, count = ids[may], weight[may], total[may], count[may]
        if not len(ids):
            break
        by_node = node[order].astype(np.uint16) if len(ids) < 1 << 16 else node[order]
        order = np.take_along_axis(order, np.argsort(by_node, axis=1, kind="stable"), axis=1)
        ends = np.cumsum(count)
        starts, segment, at = ends - count, np.repeat(np.arange(len(ids)), count), np.arange(order.shape[1])
        b = bins[order, column]
        wl, gl = np.cumsum(w[order], axis=1), np.cumsum(g[order], axis=1)
        for sums in (wl, gl):
            before = np.concatenate([np.zeros((n_features, 1)), sums[:, ends[:-1] - 1]], axis=1)
            sums -= before[:, segment]
        wr, gr = weight[segment] - wl, total[segment] - gl
        with np.errstate(divide="ignore", invalid="ignore"):
            score = gl * gl / (wl + p.l2) + gr * gr / (wr + p.l2)
        whole = total * total / np.maximum(weight + p.l2, _TINY)
        if p.growth == "oblivious":
            found = _one_cut(b, wl, gl, wr, gr, weight, total, segment, starts, p)
            if found is None:
                break
            best, cut, threshold, split = np.full(len(ids), found[0]), np.full(len(ids), found[1]), None, np.ones(len(ids), bool)
            behind = cut + 1
        else:
            ok = np.zeros(b.shape, bool)
            ok[:, :-1] = b[:, :-1] != b[:, 1:]
            ok[:, ends - 1] = False
            if p.rate:
                ok &= (wl >= p.min_leaf - 0.5) & (wr >= p.min_leaf - 0.5)
            else:
                n_left = at - starts[segment] + 1
                ok &= (n_left >= p.min_leaf) & (count[segment] - n_left >= p.min_leaf)
            drawn = None
            if p.random_cuts:
                which = np.broadcast_to(column, (n_features, len(ids)))
                u = uniform(_CUT, trees[flat["tree"][ids]][None, :], flat["path"][ids][None, :], column)
                drawn, last = cuts.drawn(which, b[:, starts], b[:, ends - 1], u)
                ok[:, :-1] &= (b[:, :-1] <= last[:, segment[:-1]]) & (b[:, 1:] > last[:, segment[1:]])
            gain = np.where(ok, score - whole[segment], -np.inf)
            top = np.maximum.reduceat(gain, starts, axis=1)
            top[~allowed[flat["tree"][ids]].T] = -np.inf
            worth = top.max(axis=0)
            least = worth - _EQUAL * (np.abs(worth) + whole)  # of cuts as good as this the first one counts
            best = np.argmax(top >= least, axis=0)
            split = least > _TINY
            hit = np.where(gain[best[segment], at] >= least[segment], at, len(at))
            first = np.minimum(np.minimum.reduceat(hit, starts), len(at) - 1)
            cut, behind = b[best, first].astype(np.int64), b[best, np.minimum(first + 1, len(at) - 1)].astype(np.int64)
            threshold = drawn[best, np.arange(len(ids))] if p.random_cuts else None
            if p.growth == "leaf":
                out.gain |= dict(zip(ids[split].tolist(), worth[split].tolist()))
                wanted = best_leaves(out.gain, out.children, p.leaves)
                split &= np.fromiter((i in wanted for i in ids.tolist()), bool, len(ids))
        if not split.any():
            break
        parents = ids[split]
        kids = out.add(parents, flat["tree"][parents], flat["path"][parents])
        flat["feature"][parents], flat["cut"][parents], flat["left"][parents] = best[split], cut[split], kids[::2]
        flat["threshold"][parents] = threshold[split] if threshold is not None else cuts.thresholds(best[split], cut[split], behind[split], p)
        flat = {k: np.concatenate([v, out.__dict__[k][-1]]) for k, v in flat.items()}
        if p.growth == "leaf":
            out.children |= {a: (l, l + 1) for a, l in zip(parents.tolist(), kids[::2].tolist())}
        order = order[split[node[order]]].reshape(n_features, -1)
        rows = order[0]
        k = node[rows]
        node[rows] = 2 * (np.cumsum(split) - 1)[k] + (bins[rows, best[k]] > cut[k])
        ids = kids
        leaf[rows] = ids[node[rows]]
    if p.growth == "leaf":
        leaf = _prune(flat, best_leaves(out.gain, out.children, p.leaves), leaf)
    return flat, leaf


def _grow_drawn(bins: np.ndarray, w: np.ndarray, g: np.ndarray, tree: np.ndarray, trees: np.ndarray, p: TreeParams, cuts: Cuts) -> tuple[dict, np.ndarray]:
    """``grow`` by levels with random cuts. A node has one cut a feature, which needs the feature's ends in the node and
    the sums on one side: rows stand in node order, features follow one another, and no feature is sorted."""
    n_features = bins.shape[1]
    out, leaf = Growing(len(trees)), tree.astype(np.int64)
    allowed = columns_of(p, trees, n_features)
    by_feature, plain = np.ascontiguousarray(bins.T), bool((w == 1).all())
    rows = np.argsort(leaf, kind="stable")
    node, ids = leaf[rows], np.arange(len(trees))  # ids: the open nodes; node: each row's place in it, ascending
    flat = out.flat()
    for depth in range(p.depth + 1):
        count = np.bincount(node, minlength=len(ids))
        weight, total = np.bincount(node, w[rows], len(ids)), np.bincount(node, g[rows], len(ids))
        flat["value"][ids], flat["cover"][ids] = total / np.maximum(weight + p.l2, _TINY), weight
        if depth == p.depth:
            break
        may = count >= 2
        if not may.all():  # nodes of one row or none are leaves
            on = may[node]
            rows, node = rows[on], (np.cumsum(may) - 1)[node[on]]
            ids, weight, total, count = ids[may], weight[may], total[may], count[may]
        if not len(ids):
            break
        starts, here = np.cumsum(count) - count, g[rows]
        whole = total * total / np.maximum(weight + p.l2, _TINY)
        which, path = trees[flat["tree"][ids]], flat["path"][ids]
        top, drawn, last = np.empty((n_features, len(ids))), np.empty((n_features, len(ids))), np.empty((n_features, len(ids)), np.uint8)
        for j, v in enumerate(cuts.values):
            b = by_feature[j][rows]
            low, high = np.minimum.reduceat(b, starts), np.maximum.reduceat(b, starts)
            drawn[j] = v[low] + uniform(_CUT, which, path, j) * (v[high] - v[low])
            last[j] = np.searchsorted(v, drawn[j], "right") - 1
            left = b <= np.repeat(last[j], count)
            kl, gl = np.add.reduceat(left, starts, dtype=np.int64), np.add.reduceat(here * left, starts)
            wl = kl.astype(float) if plain else np.add.reduceat(w[rows] * left, starts)
            below, above = (wl, weight - wl) if p.rate else (kl, count - kl)
            ok = (kl < count) & (below >= p.min_leaf - 0.5) & (above >= p.min_leaf - 0.5) & allowed[flat["tree"][ids], j]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = gl * gl / (wl + p.l2) + (total - gl) ** 2 / (weight - wl + p.l2) - whole
            top[j] = np.where(ok, gain, -np.inf)
        worth = top.max(axis=0)
        least = worth - _EQUAL * (np.abs(worth) + whole)  # of cuts as good as this the first one counts
        best, split = np.argmax(top >= least, axis=0), least > _TINY
        if not split.any():
            break
        on = np.repeat(split, count)
        rows, best, last, count = rows[on], best[split], last[best, np.arange(len(ids))][split], count[split]
        starts = np.cumsum(count) - count
        b = bins[rows, np.repeat(best, count)]
        right = b > np.repeat(last, count)
        parents = ids[split]
        kids = out.add(parents, flat["tree"][parents], flat["path"][parents])
        flat["feature"][parents], flat["cut"][parents], flat["left"][parents] = best, np.maximum.reduceat(np.where(right, 0, b), starts), kids[::2]
        flat["threshold"][parents] = drawn[best, np.flatnonzero(split)]
        flat = {k: np.concatenate([v, out.__dict__[k][-1]]) for k, v in flat.items()}
        ids, node = kids, np.repeat(2 * np.arange(len(parents)), count) + right
        order = np.argsort(node.astype(np.uint16) if len(kids) < 1 << 16 else node, kind="stable")
        rows, node = rows[order], node[order]
        leaf[rows] = ids[node]
    return flat, leaf


def _one_cut(b, wl, gl, wr, gr, weight, total, segment, starts, p: TreeParams) -> tuple[int, int] | None:
    """Feature and bin of the cut of all nodes of a level that makes the leaf means point most nearly along the target:
    sum G^2/(W+l2) over the root of sum W (G/(W+l2))^2. A row that passes the cut changes its own node's two leaves
    only, so the changes of a bin's rows add up over the nodes, and running sums over bins give every cut."""
    def both(f):
        with np.errstate(divide="ignore", invalid="ignore"):
            here, none = f(wl, gl) + f(wr, gr), f(weight, total)
        before = np.concatenate([np.zeros((len(here), 1)), here[:, :-1]], axis=1)
        before[:, starts] = none
        keyed = (np.arange(len(b))[:, None] * MAX_BINS + b).ravel()
        moved = np.bincount(keyed, np.nan_to_num(here - before).ravel(), len(b) * MAX_BINS).reshape(len(b), MAX_BINS)
        return none.sum() + np.cumsum(moved, axis=1)

    dot = both(lambda w, g: g * g / np.maximum(w + p.l2, _TINY))
    norm = both(lambda w, g: w * (g / np.maximum(w + p.l2, _TINY)) ** 2)
    cosine = dot / np.sqrt(np.maximum(norm, _TINY))
    return _first_best(cosine, b.max(axis=1))


def _first_best(score: np.ndarray, top: np.ndarray) -> tuple[int, int] | None:
    """The first of the best cuts below each feature's highest bin; none if no feature has one."""
    score[np.arange(MAX_BINS)[None, :] >= top[:, None]] = -np.inf
    best = score.max()
    if not np.isfinite(best):
        return None
    feature, cut = np.unravel_index(np.argmax(score >= best - _EQUAL * abs(best)), score.shape)
    return int(feature), int(cut)


def _prune(flat: dict, split: set[int], leaf: np.ndarray) -> np.ndarray:
    """Makes leaves of the nodes that are not split in the end; returns the rows' leaves."""
    top = np.arange(len(flat["left"]))
    for i in range(len(top)):
        left = flat["left"][i]
        if left < 0:
            continue
        if i not in split or top[i] != i:
            top[left] = top[left + 1] = top[i]
    gone = np.array([i not in split for i in range(len(top))])
    flat["feature"][gone], flat["left"][gone] = -1, -1
    return top[leaf]


# ---------------------------------------------------------------- a series in one task
MODEL = "first_tree int, base double, scale double, root array<int>, feature array<int>, threshold array<double>, left array<int>, value array<double>, cover array<double>"


def _packed(parts: list[dict], first: int, base: float, scale: float) -> dict:
    """Node arrays of several growings as one row of the model table."""
    roots, shift, out = [], 0, {k: [] for k in ("feature", "threshold", "left", "value", "cover")}
    for f in parts:
        roots.append(np.arange(f["tree"].max() + 1) + shift)
        for k in out:
            out[k].append(np.where(f[k] >= 0, f[k] + shift, -1) if k == "left" else f[k])
        shift += len(f["left"])
    return {"first_tree": first, "base": base, "scale": scale, "root": np.concatenate(roots)} | {k: np.concatenate(v) for k, v in out.items()}


def fit_series(bins: np.ndarray, row: np.ndarray, y: np.ndarray, cuts: Cuts, p: TreeParams, first: int, n: int) -> dict:
    """Model row of the trees first..first+n-1 of a forest, or of all rounds of a boosted model."""
    parts, base = [], float(y.mean())
    if not p.rate:
        step = max(1, SIDE_BY_SIDE // max(1, len(y)))
        for a in range(first, first + n, step):
            trees = np.arange(a, min(a + step, first + n))
            t, r = np.nonzero(weights := row_weights(p, trees, row))
            w = weights[t, r]
            parts.append(grow(bins[r], w, w * (y[r] - base), t, trees, p, cuts)[0])
        return _packed(parts, first, base, 1.0 / p.trees)
    error, one = y - base, np.zeros(len(y), np.int64)
    for round_ in range(p.trees):
        trees = np.array([round_])
        w = row_weights(p, trees, row)[0]
        flat, leaf = grow(bins, w, w * error, one, trees, p, cuts)
        flat["value"] *= p.rate
        error -= flat["value"][leaf]
        parts.append(flat)
    return _packed(parts, 0, base, 1.0)


def fit_trees(blocks: DataFrame, cuts: DataFrame, p: TreeParams, keys: list[str]) -> DataFrame:
    """Model table: (keys..., first_tree, base, scale, node arrays), a row per series and part of its trees.

    ``scale`` times the sum of the leaf values plus ``base`` (the mean target) is the prediction. A series without
    rows has no model."""
    n_parts = p.parts if not p.rate else 1
    sizes = [len(x) for x in np.array_split(np.arange(p.trees), n_parts)]
    firsts = np.cumsum([0, *sizes[:-1]])
    parts = F.explode(F.array(*[F.struct(F.lit(int(a)).alias("first"), F.lit(int(n)).alias("trees")) for a, n in zip(firsts, sizes)])).alias("part")
    short = cuts.filter(F.col("n") <= task_rows(p)).select(*keys, "values", parts).select(*keys, "values", "part.first", "part.trees")
    kept = cuts.filter(F.col("n") <= task_rows(p)).select(*keys)
    work = blocks.join(kept, keys, "left_semi").select("*", parts).select(*blocks.columns, F.col("part.first").alias("first"))

    def fit(head: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "first_tree", "base", "scale", "root", "feature", "threshold", "left", "value", "cover"]
        if not len(head) or not len(pdf):
            return pd.DataFrame(columns=names)
        pdf, c = pdf.sort_values("blk"), Cuts(head["values"].iloc[0])
        bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(-1, len(c.edges))
        row, y = np.frombuffer(b"".join(pdf["row"]), np.int64), np.frombuffer(b"".join(pdf["y"]))
        made = fit_series(bins, row, y, c, p, int(head["first"].iloc[0]), int(head["trees"].iloc[0]))
        return pd.DataFrame([{k: pdf[k].iloc[0] for k in keys} | made], columns=names)

    # a model costs far more than its bytes tell: it gets a partition, which is not merged with others for its size
    spark = blocks.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * n_parts * cuts.count(), 32 * spark.sparkContext.defaultParallelism))
    work = work.repartition(n, *keys, "first")
    head = short.toDF(*[f"_{k}" for k in keys], "values", "first", "trees").repartition(n, *[f"_{k}" for k in keys], "first")
    out = head.groupBy(*[f"_{k}" for k in keys], "first").cogroup(work.groupBy(*keys, "first")).applyInPandas(fit, f"{_key_types(blocks, keys)}, {MODEL}")
    long = cuts.filter(F.col("n") > task_rows(p))
    if long.isEmpty():
        return out
    return out.unionByName(fit_by_levels(blocks, long, p, keys))


# ---------------------------------------------------------------- a long series, level by level
#: Long series, and trees of a forest, that grow side by side; rounds after which the blocks keep their predictions.
LONG_TOGETHER, TREES_TOGETHER, ROUNDS_KEPT = 8, 16, 25
_HELD_CELLS = 4_000_000


def _descend(flat: dict, bins: np.ndarray, tree: int) -> np.ndarray:
    """Each row's node in a growing tree."""
    at = np.full(len(bins), tree, np.int64)
    while True:
        f = flat["feature"][at]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return at
        at[inner] = flat["left"][at[inner]] + (bins[inner, f[inner]] > flat["cut"][at[inner]])
        if not (flat["feature"][at[inner]] >= 0).any():
            return at


def _cells(held: list[tuple]) -> pd.DataFrame:
    """Cell sums of a task: (place, tree, node, cell, w, g, k) with one row per series, tree and node."""
    place, tree, node, cell, w, g = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((cell, node, tree, place))
    place, tree, node, cell, w, g = (x[order] for x in (place, tree, node, cell, w, g))
    new = np.flatnonzero(np.concatenate([[True], (np.diff(cell) != 0) | (np.diff(node) != 0) | (np.diff(tree) != 0) | (np.diff(place) != 0)]))
    w, g, k = np.add.reduceat(w, new), np.add.reduceat(g, new), np.diff(np.append(new, len(cell)))
    place, tree, node, cell = place[new], tree[new], node[new], cell[new]
    start = np.flatnonzero(np.concatenate([[True], (np.diff(node) != 0) | (np.diff(tree) != 0) | (np.diff(place) != 0)]))
    ends = np.append(start[1:], len(cell))
    return pd.DataFrame({"place": place[start], "tree": tree[start], "node": node[start], "cell": [cell[a:b].astype(np.int32).tobytes() for a, b in zip(start, ends)],
                         "w": [w[a:b].tobytes() for a, b in zip(start, ends)], "g": [g[a:b].tobytes() for a, b in zip(start, ends)],
                         "k": [k[a:b].astype(np.int64).tobytes() for a, b in zip(start, ends)]})


def _summed(pdf: pd.DataFrame, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight, target sum and row count of every feature and bin of a node."""
    size = n_features * MAX_BINS
    cell = np.concatenate([np.frombuffer(c, np.int32) for c in pdf["cell"]])
    sums = [np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in (("w", float), ("g", float), ("k", np.int64))]
    return tuple(np.bincount(cell, x, size).reshape(n_features, MAX_BINS) for x in sums)


def _best_cut(w, g, k, p: TreeParams, cuts: Cuts, allowed: np.ndarray, tree: int, path: int) -> tuple[int, int, float, float]:
    """Feature, bin, threshold and gain of a node's best cut (gain 0: none), by the rules of ``grow``."""
    wl, gl, kl = np.cumsum(w, axis=1), np.cumsum(g, axis=1), np.cumsum(k, axis=1)
    weight, total, count = wl[:, -1:], gl[:, -1:], kl[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl ** 2 / (wl + p.l2) + (total - gl) ** 2 / (weight - wl + p.l2) - total ** 2 / (weight + p.l2)
    left, right = (wl, weight - wl) if p.rate else (kl, count - kl)
    ok = (k > 0) & (kl < count) & (left >= p.min_leaf - 0.5) & (right >= p.min_leaf - 0.5)
    drawn = None
    if p.random_cuts:
        low, high = np.argmax(k > 0, axis=1), MAX_BINS - 1 - np.argmax(k[:, ::-1] > 0, axis=1)
        drawn, last = cuts.drawn(np.arange(len(k)), low, high, uniform(_CUT, tree, path, np.arange(len(k))))
        bins = np.arange(MAX_BINS)[None, :]
        below = (k > 0) & (bins <= last[:, None])
        ok &= bins == (MAX_BINS - 1 - np.argmax(below[:, ::-1], axis=1))[:, None]
    gain = np.where(ok & allowed[:, None], gain, -np.inf)
    worth = gain.max()
    least = worth - _EQUAL * (abs(worth) + float((total[0] ** 2 / np.maximum(weight[0] + p.l2, _TINY))[0]))
    if not least > _TINY:
        return -1, 0, 0.0, 0.0
    feature, cut = np.unravel_index(np.argmax(gain >= least), gain.shape)
    behind = cut + 1 + int(np.argmax(k[feature, cut + 1:] > 0))
    at = float(drawn[feature]) if drawn is not None else float(cuts.thresholds([feature], [cut], [behind], p)[0])
    return int(feature), int(cut), at, float(worth)


def _grow_long(blocks: DataFrame, series: list[dict], p: TreeParams, keys: list[str], trees: np.ndarray) -> list[dict]:
    """Flat node arrays of the same trees of each of a few long series, one job a level.

    ``series``: key, cuts, and for a boosted model its base and the rounds since the blocks kept their predictions.
    A task sums up the cells of its blocks; those of a node meet in one group of at most features x bins cells a task.
    The nodes of the open trees (a few series, ``TREES_TOGETHER`` trees) pass through the driver."""
    spark = blocks.sparkSession
    n_features = len(series[0]["cuts"].edges)
    growing, flats = [Growing(len(trees)) for _ in series], []
    flats = [g.flat() for g in growing]
    open_ = [set(range(len(trees))) for _ in series]
    allowed = columns_of(p, trees, n_features)
    for depth in range(p.depth + 1):
        told = spark.sparkContext.broadcast((series, flats, [np.array(sorted(o), np.int64) for o in open_], trees))

        def cells(batches):
            series, flats, opened, trees = told.value
            place_of = {s["key"]: i for i, s in enumerate(series)}
            held, size = [], 0
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    i = place_of[tuple(getattr(r, k) for k in keys)]
                    bins = np.frombuffer(r.bins, np.uint8).reshape(-1, n_features)
                    row, y = np.frombuffer(r.row, np.int64), np.frombuffer(r.y)
                    y = y - (_boosted(series[i], bins, r.kept) if p.rate else series[i]["base"])
                    weights = row_weights(p, trees, row)
                    for t in range(len(trees)):
                        at = _descend(flats[i], bins, t)
                        on = np.flatnonzero(np.isin(at, opened[i]) & ((weights[t] > 0) | bool(p.rate)))
                        if not len(on):
                            continue
                        w, n = weights[t][on], len(on) * n_features
                        cell = bins[on].astype(np.int64) + np.arange(n_features) * MAX_BINS
                        held.append((np.full(n, i), np.full(n, t), np.repeat(at[on], n_features), cell.ravel(), np.repeat(w, n_features), np.repeat(w * y[on], n_features)))
                        size += n
                        if size > _HELD_CELLS:
                            yield _cells(held)
                            held, size = [], 0
            if held:
                yield _cells(held)

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            series, flats, _, trees = told.value
            i, t = int(pdf["place"].iloc[0]), int(pdf["tree"].iloc[0])
            out = []
            nodes = [(int(n), _summed(x, n_features)) for n, x in pdf.groupby("node")]
            if p.growth == "oblivious" and depth < p.depth:
                found = _one_cut_of(nodes, p)
            for node, (w, g, k) in nodes:
                weight, total = float(w[0].sum()), float(g[0].sum())
                cut = (-1, 0, 0.0, 0.0)
                if depth < p.depth and k[0].sum() >= 2:
                    c = series[i]["cuts"]
                    if p.growth == "oblivious":
                        cut = (-1, 0, 0.0, 0.0) if found is None else (*found, float(c.thresholds([found[0]], [found[1]], [found[1] + 1], p)[0]), 1.0)
                    else:
                        cut = _best_cut(w, g, k, p, c, allowed[t], int(trees[t]), int(flats[i]["path"][node]))
                out.append((i, t, node, weight, total, *cut))
            return pd.DataFrame(out, columns=["place", "tree", "node", "weight", "total", "feature", "cut", "threshold", "gain"])

        columns = [*keys, "row", "bins", "y"] + (["kept"] if p.rate else [])
        sums = blocks.select(*columns).mapInPandas(cells, "place int, tree int, node long, cell binary, w binary, g binary, k binary")
        by = ["place", "tree"] if p.growth == "oblivious" else ["place", "tree", "node"]
        found = sums.groupBy(*by).applyInPandas(choose, "place int, tree int, node long, weight double, total double, feature int, cut int, threshold double, gain double").toPandas()
        told.unpersist()
        for i, (own, flat) in enumerate(zip(growing, flats)):
            f = found[found["place"] == i].sort_values("node")
            node = f["node"].to_numpy(np.int64)
            flat["value"][node], flat["cover"][node] = f["total"] / np.maximum(f["weight"] + p.l2, _TINY), f["weight"]
            f = f[f["feature"] >= 0]
            if p.growth == "leaf":
                own.gain |= dict(zip(f["node"].tolist(), f["gain"].tolist()))
                wanted = best_leaves(own.gain, own.children, p.leaves)
                f = f[f["node"].isin(wanted)]
            parents = f["node"].to_numpy(np.int64)
            kids = own.add(parents, flat["tree"][parents], flat["path"][parents])
            for name in ("feature", "cut", "threshold"):
                flat[name][parents] = f[name].to_numpy()
            flat["left"][parents] = kids[::2]
            own.children |= {a: (l, l + 1) for a, l in zip(parents.tolist(), kids[::2].tolist())}
            flats[i] = {k: np.concatenate([v, own.__dict__[k][-1]]) for k, v in flat.items()}
            open_[i] = set(kids.tolist())
        if not any(open_):
            break
    if p.growth == "leaf":
        for own, flat in zip(growing, flats):
            _prune(flat, best_leaves(own.gain, own.children, p.leaves), np.zeros(0, np.int64))
    return flats


def _one_cut_of(nodes: list, p: TreeParams) -> tuple[int, int] | None:
    """``_one_cut`` from the cell sums of a level's nodes."""
    dot = norm = 0.0
    top = np.max([np.where(k > 0, np.arange(MAX_BINS), -1).max(axis=1) for _, (_, _, k) in nodes], axis=0)
    for _, (w, g, k) in nodes:
        wl, gl = np.cumsum(w, axis=1), np.cumsum(g, axis=1)
        for a, b in ((wl, gl), (wl[:, -1:] - wl, gl[:, -1:] - gl)):
            mean = b / np.maximum(a + p.l2, _TINY)
            dot, norm = dot + b * mean, norm + a * mean ** 2
    cosine = dot / np.sqrt(np.maximum(norm, _TINY))
    return _first_best(cosine, top)


def _boosted(s: dict, bins: np.ndarray, kept: bytes | None) -> np.ndarray:
    """Predictions so far: those the block keeps, and the rounds since."""
    out = np.frombuffer(kept).copy() if kept else np.full(len(bins), s["base"])
    for flat in s["rounds"]:
        out += flat["value"][_descend(flat, bins, 0)]
    return out


def fit_by_levels(blocks: DataFrame, long: DataFrame, p: TreeParams, keys: list[str]) -> DataFrame:
    """Model table of series that are too long for a task, a few of them side by side."""
    from hourcast.session import materialize
    spark, tables = blocks.sparkSession, []
    every = [tuple(r) for r in long.select(*keys).toLocalIterator()]  # keys only
    schema = spark.createDataFrame([], f"{_key_types(blocks, keys)}, {MODEL}").schema
    for a in range(0, len(every), LONG_TOGETHER):
        group = spark.createDataFrame(every[a:a + LONG_TOGETHER], long.select(*keys).schema)
        own = blocks.join(F.broadcast(group), keys, "left_semi")  # LONG_TOGETHER rows at most
        means = own.select(*keys, "y").mapInPandas(_block_sums(keys), f"{_key_types(blocks, keys)}, n long, total double")
        means = {tuple(r[k] for k in keys): r["total"] / r["n"] for r in means.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
        series = [{"key": tuple(r[k] for k in keys), "cuts": Cuts(r["values"]), "rounds": [], "parts": []} for r in long.join(F.broadcast(group), keys, "left_semi").collect()]
        for s in series:
            s["base"] = means[s["key"]]
        if p.rate:
            own = own.withColumn("kept", F.lit(None).cast("binary"))
            for round_ in range(p.trees):
                sent = [{k: s[k] for k in ("key", "cuts", "base", "rounds")} for s in series]
                for s, flat in zip(series, _grow_long(own, sent, p, keys, np.array([round_]))):
                    flat["value"] *= p.rate
                    s["rounds"] = [*s["rounds"], flat]
                    s["parts"].append(flat)
                if (round_ + 1) % ROUNDS_KEPT == 0 and round_ + 1 < p.trees:
                    own = materialize(_keeping(own, [{k: s[k] for k in ("key", "base", "rounds")} for s in series], keys, len(series[0]["cuts"].edges)), "boosted-blocks")
                    for s in series:
                        s["rounds"] = []
        else:
            for first in range(0, p.trees, TREES_TOGETHER):
                trees = np.arange(first, min(p.trees, first + TREES_TOGETHER))
                for s, flat in zip(series, _grow_long(own, [{k: s[k] for k in ("key", "cuts", "base")} for s in series], p, keys, trees)):
                    s["parts"].append(flat)
        rows = []
        for s in series:
            made = _packed(s["parts"], 0, s["base"], 1.0 if p.rate else 1.0 / p.trees)
            rows.append((*s["key"], *[v.tolist() if isinstance(v, np.ndarray) else v for v in made.values()]))
        tables.append(materialize(spark.createDataFrame(rows, schema), "long-series-trees"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _block_sums(keys: list[str]):
    def run(batches):
        for pdf in batches:
            y = [np.frombuffer(b) for b in pdf["y"]]
            yield pd.DataFrame({k: pdf[k] for k in keys} | {"n": [len(v) for v in y], "total": [float(v.sum()) for v in y]})
    return run


def _keeping(blocks: DataFrame, series: list[dict], keys: list[str], n_features: int) -> DataFrame:
    told = blocks.sparkSession.sparkContext.broadcast(series)

    def run(batches):
        of = {s["key"]: s for s in told.value}
        for pdf in batches:
            pdf["kept"] = [_boosted(of[tuple(getattr(r, k) for k in keys)], np.frombuffer(r.bins, np.uint8).reshape(-1, n_features), r.kept).tobytes()
                           for r in pdf.itertuples(index=False)]
            yield pdf
    return blocks.mapInPandas(run, blocks.schema)


# ---------------------------------------------------------------- predictions
def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` by these columns in partitions that are not merged for their size: trees cost more than bytes tell."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *cols)


def leaves_of(m, x: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Leaf of each row in each tree, [row, tree]."""
    feature, threshold, left = (np.asarray(m[k]) for k in ("feature", "threshold", "left"))
    at = np.broadcast_to(roots, (len(x), len(roots))).copy()
    todo = feature[at] >= 0
    while todo.any():
        r, t = np.nonzero(todo)
        node = at[r, t]
        at[r, t] = left[node] + (x[r, feature[node]] > threshold[node])
        todo[r, t] = feature[at[r, t]] >= 0
    return at


def predicted(models: pd.DataFrame, x: np.ndarray) -> np.ndarray:
    """Predictions of rows by all parts of a series' model."""
    out = np.zeros(len(x))
    for m in models.to_dict("records"):
        roots, value = np.asarray(m["root"], np.int64), np.asarray(m["value"])
        for a in range(0, len(x), 2_048):
            for b in range(0, len(roots), 64):
                out[a:a + 2_048] += m["scale"] * value[leaves_of(m, x[a:a + 2_048], roots[b:b + 64])].sum(axis=1)
    return out + models["base"].max() if len(models) else np.full(len(x), np.nan)


def by_block(rows: DataFrame, models: DataFrame, features: list[str], keys: list[str], keep: list[str], apply, schema: str, position: str = "idx") -> DataFrame:
    """``apply(model rows, kept columns, features as doubles)`` for every block of rows and its series' model parts."""
    d = rows.select(*keys, *keep, F.floor(F.col(position) / BLOCK_ROWS).alias("_blk"), *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(features)])
    d = d.dropna(subset=[f"_x{j}" for j in range(len(features))])
    heads = d.select(*keys, "_blk").distinct().join(models, keys)
    heads = heads.toDF(*[f"_{c}" if c in (*keys, "_blk") else c for c in heads.columns])

    def run(m: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(m) or not len(r):
            return pd.DataFrame(columns=[c.split()[0].strip("`") for c in schema.split(", ")])
        return apply(m, r[[*keys, *keep]], r[[f"_x{j}" for j in range(len(features))]].to_numpy(float))

    heads, d = spread(heads, *[f"_{k}" for k in keys], "__blk"), spread(d, *keys, "_blk")
    return heads.groupBy(*[f"_{k}" for k in keys], "__blk").cogroup(d.groupBy(*keys, "_blk")).applyInPandas(run, schema)


def predict_trees(rows: DataFrame, models: DataFrame, features: list[str], keys: list[str], keep: list[str], out: str = "yhat", position: str = "idx") -> DataFrame:
    """(keys..., keep..., yhat) of every row whose series has a model and whose features are not null."""
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return by_block(rows, models, features, keys, keep, lambda m, r, x: r.assign(**{out: predicted(m, x)}), f"{_key_types(rows, keys)}, {kinds}, {out} double", position)


# ---------------------------------------------------------------- tuning
def tune_trees(rows: DataFrame, preset: dict, grid: list[dict], features: list[str], keys: list[str], k: int = C.CV_N_SPLITS, position: str = "idx") -> DataFrame:
    """(keys..., param_id, cv_mae): the point of ``grid`` (changes to ``preset``) with the lowest mean fold MAE.

    Expanding folds as for the linear models: of a series' n rows the last k blocks of n div (k + 1) are test blocks, and
    a fold trains on all rows before its own. All points and folds share one binning of the series' rows; a task has one
    point and fold of one series, or, for a series that is too long for a task, the level jobs have. ``position``
    numbers a series' rows from 0 without gaps; rows with a null feature or target are not allowed for. A series with
    fewer than k + 1 rows has no result."""
    points = [TreeParams(**(preset | point)) for point in grid]
    counted = cut_values(rows, features, keys).withColumn("size", F.floor(F.col("n") / (k + 1))).filter("size > 0")
    blocks = binned_blocks(rows, features, keys, counted.drop("size"), position)
    units = F.explode(F.array(*[F.struct(F.lit(d).alias("draw"), F.lit(f).alias("fold")) for d in range(len(points)) for f in range(1, k + 1)])).alias("u")
    short = counted.filter(F.col("n") <= TASK_ROWS)
    head = short.select(*keys, "values", "n", "size", units).select(*[F.col(c).alias(f"_{c}") for c in keys], "values", "n", "size", "u.draw", "u.fold")
    work = blocks.join(short.select(*keys), keys, "left_semi").select("*", units).select(*blocks.columns, "u.draw", "u.fold")

    def score(h: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "draw", "fold", "mae"]
        if not len(h) or not len(b):
            return pd.DataFrame(columns=names)
        b, c, one = b.sort_values("blk"), Cuts(h["values"].iloc[0]), h.iloc[0]
        bins = np.frombuffer(b"".join(b["bins"]), np.uint8).reshape(-1, len(c.edges))
        row, y = np.frombuffer(b"".join(b["row"]), np.int64), np.frombuffer(b"".join(b["y"]))
        p, start = points[int(one["draw"])], int(one["n"] - (k + 1 - one["fold"]) * one["size"])
        model = fit_series(bins[:start], row[:start], y[:start], c, p, 0, p.trees)
        test = slice(start, start + int(one["size"]))
        x = np.column_stack([v[bins[test, j]] for j, v in enumerate(c.values)])  # a value of each row's bin stands for it
        error = np.abs(predicted(pd.DataFrame([model]), x) - y[test])
        return pd.DataFrame([{q: b[q].iloc[0] for q in keys} | {"draw": int(one["draw"]), "fold": int(one["fold"]), "mae": error.mean()}], columns=names)

    left, right = spread(head, *[f"_{c}" for c in keys], "draw", "fold"), spread(work, *keys, "draw", "fold")
    folds = left.groupBy(*[f"_{c}" for c in keys], "draw", "fold").cogroup(right.groupBy(*keys, "draw", "fold")).applyInPandas(
        score, f"{_key_types(rows, keys)}, draw int, fold int, mae double")
    long = counted.filter(F.col("n") > TASK_ROWS)
    if not long.isEmpty():
        d = rows.join(long.select(*keys, F.col("n").alias("_n"), "size"), keys)
        for draw, p in enumerate(points):
            for fold in range(1, k + 1):
                start = F.col("_n") - (k + 1 - fold) * F.col("size")
                train, test = d.filter(F.col(position) < start), d.filter((F.col(position) >= start) & (F.col(position) < start + F.col("size")))
                models = fit_trees(binned_blocks(train, features, keys, long.drop("size"), position), long.drop("size"), p, keys)
                pred = predict_trees(test, models, features, keys, ["y"], position=position)
                folds = folds.unionByName(pred.groupBy(*keys).agg(F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae")).select(
                    *keys, F.lit(draw).alias("draw"), F.lit(fold).alias("fold"), "mae"))
    cv = folds.groupBy(*keys, "draw").agg(F.avg("mae").alias("cv_mae"))
    return cv.groupBy(*keys).agg(F.min(F.struct("cv_mae", "draw")).alias("b")).select(*keys, F.col("b.draw").alias("param_id"), F.col("b.cv_mae").alias("cv_mae"))

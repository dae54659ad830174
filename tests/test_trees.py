"""Tree ensembles: one tree against exhaustive search, draws, growth orders, level jobs against tasks, attributions."""
import itertools
import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourcast.operators import explain as EX
from hourcast.operators import trees as T
from hourcast.operators.trees import Cuts, TreeParams

FEATURES = ["a", "b", "c"]


def sample(seed=0, n=120, f=4, levels=9):
    r = np.random.RandomState(seed)
    x = r.randint(0, levels, (n, f)).astype(float) / 3
    y = x[:, 0] ** 2 - 2 * x[:, 1] * (x[:, 2] > 1) + r.randn(n) * 0.3
    return x, y, Cuts([np.unique(x[:, j]) for j in range(f)])


def one_tree(x, y, cuts, p, tree=0, w=None):
    w = np.ones(len(y)) if w is None else w
    return T.grow(cuts.bins(x), w, w * y, np.zeros(len(y), int), np.array([tree]), p, cuts)


def walk(flat, x, node=0):
    while flat["feature"][node] >= 0:
        node = flat["left"][node] + (x[flat["feature"][node]] > flat["threshold"][node])
    return node


def best_split(x, y, l2, min_leaf, features):
    """Every feature and every middle between neighbours."""
    best, whole = (1e-10, None, None), y.sum() ** 2 / (len(y) + l2)
    for f in features:
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:]):
            left = x[:, f] <= low
            if min(left.sum(), (~left).sum()) < min_leaf:
                continue
            gain = y[left].sum() ** 2 / (left.sum() + l2) + y[~left].sum() ** 2 / ((~left).sum() + l2) - whole
            if gain > best[0] + 1e-9:
                best = (gain, f, (low, high))
    return best


def exhaustive(x, y, depth, l2, min_leaf):
    """Predictions of the greedy tree."""
    gain, f, between = best_split(x, y, l2, min_leaf, range(x.shape[1])) if depth and len(y) >= 2 else (0, None, None)
    if f is None:
        return np.full(len(y), y.sum() / (len(y) + l2))
    out, left = np.empty(len(y)), x[:, f] <= between[0]
    out[left], out[~left] = exhaustive(x[left], y[left], depth - 1, l2, min_leaf), exhaustive(x[~left], y[~left], depth - 1, l2, min_leaf)
    return out


@pytest.mark.parametrize("depth,l2,min_leaf,rate", [(3, 1.0, 1, 0.5), (6, 0.0, 5, 0.5), (12, 0.0, 2, 0.0)])
def test_one_tree_against_exhaustive_search(depth, l2, min_leaf, rate):
    x, y, cuts = sample()
    flat, leaf = one_tree(x, y, cuts, TreeParams(1, depth, min_leaf, rate, l2))
    assert np.allclose(flat["value"][leaf], exhaustive(x, y, depth, l2, min_leaf))
    assert [walk(flat, row) for row in x] == leaf.tolist()
    assert np.allclose(np.bincount(leaf, minlength=len(flat["cover"]))[np.unique(leaf)], flat["cover"][np.unique(leaf)])


def test_several_trees_side_by_side_equal_those_alone():
    x, y, cuts = sample(1)
    p = TreeParams(6, 5, 2, bootstrap=True)
    together = T.fit_series(cuts.bins(x), np.arange(len(y)), y, cuts, p, 0, 6)
    alone = [T.fit_series(cuts.bins(x), np.arange(len(y)), y, cuts, p, t, 1) for t in range(6)]
    a, b = (T.predicted(pd.DataFrame(ms), x) for ms in ([together], alone))
    assert np.allclose(a, b)


def test_bootstrap_draws_are_poisson_and_columns_are_a_share():
    w = T.row_weights(TreeParams(200, 1, bootstrap=True), np.arange(200), np.arange(500))
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05 and abs((w == 0).mean() - math.exp(-1)) < 0.01
    assert abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.2
    seen = T.columns_of(TreeParams(400, 1, columns=0.8), np.arange(400), 34)
    assert (seen.sum(axis=1) == 27).all() and 0.7 < seen.mean(axis=0).min()
    some = T.row_weights(TreeParams(20, 1, rate=0.1, rows=0.8), np.arange(20), np.arange(1_000))
    assert abs(some.mean() - 0.8) < 0.02


def test_random_cuts_are_drawn_and_the_best_of_them_is_taken():
    x, y, cuts = sample(2, n=300, levels=40)
    p = TreeParams(40, 1, 2, random_cuts=True)
    chosen = []
    for t in range(40):
        flat, _ = one_tree(x, y, cuts, p, t)
        u = T.uniform(3, t, 1, np.arange(x.shape[1]))
        at = x.min(axis=0) + u * (x.max(axis=0) - x.min(axis=0))
        gains = []
        for f in range(x.shape[1]):
            left = x[:, f] <= at[f]
            ok = min(left.sum(), (~left).sum()) >= 2
            gains.append(y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() if ok else -1)
        assert flat["feature"][0] == int(np.argmax(gains)) and np.isclose(flat["threshold"][0], at[flat["feature"][0]])
        chosen.append(flat["threshold"][0])
    assert len(set(chosen)) == 40


def naive_drawn(x, y, w, p, tree, path=1, depth=0):
    """Each row's leaf value of a tree of random cuts, by recursion."""
    mean = np.full(len(y), (w * y).sum() / w.sum())
    if depth == p.depth or len(y) < 2:
        return mean
    u = T.uniform(3, tree, path, np.arange(x.shape[1]))
    best, kept = 1e-10, None
    for f in range(x.shape[1]):
        left = x[:, f] <= x[:, f].min() + u[f] * (x[:, f].max() - x[:, f].min())
        if min(left.sum(), (~left).sum()) < p.min_leaf:
            continue
        gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (w * y).sum() ** 2 / w.sum()
        if gain > best * (1 + 1e-9):
            best, kept = gain, left
    if kept is None:
        return mean
    for side, on in enumerate((kept, ~kept)):
        mean[on] = naive_drawn(x[on], y[on], w[on], p, tree, 2 * path + side, depth + 1)
    return mean


def test_trees_of_random_cuts_side_by_side_with_weights():
    x, y, cuts = sample(5, n=260, levels=30)
    p = TreeParams(3, 7, 3, random_cuts=True, bootstrap=True)
    trees = np.arange(3)
    t, r = np.nonzero(weights := T.row_weights(p, trees, np.arange(len(y))))
    w = weights[t, r]
    flat, leaf = T.grow(cuts.bins(x)[r], w, w * y[r], t, trees, p, cuts)
    for i in trees:
        assert np.allclose(flat["value"][leaf[t == i]], naive_drawn(x[r[t == i]], y[r[t == i]], w[t == i], p, i))
    assert (flat["tree"][leaf] == t).all()


def test_random_cuts_take_little_memory_for_a_row():
    r = np.random.RandomState(0)
    n, f = 8_000, 34
    bins, y, one = r.randint(0, 256, (n, f)).astype(np.uint8), r.randn(n), np.ones(n)
    cuts = Cuts([np.arange(256.0)] * f)
    tracemalloc.start()
    try:
        T.grow(bins, one, y, np.zeros(n, int), np.array([0]), TreeParams(1, 6, 2, random_cuts=True), cuts)
        assert tracemalloc.get_traced_memory()[1] < 700 * n
    finally:
        tracemalloc.stop()


def test_best_leaf_first():
    x, y, cuts = sample(3, n=200)
    p = TreeParams(1, 8, 5, 0.5, growth="leaf", leaves=7)
    flat, leaf = one_tree(x, y, cuts, p)
    groups = [np.arange(len(y))]
    for _ in range(6):
        gains = [best_split(x[g], y[g], 0.0, 5, range(x.shape[1])) for g in groups]
        i = int(np.argmax([b[0] for b in gains]))
        left = x[groups[i], gains[i][1]] <= gains[i][2][0]
        groups[i:i + 1] = [groups[i][left], groups[i][~left]]
    expected = np.empty(len(y))
    for g in groups:
        expected[g] = y[g].mean()
    assert len(np.unique(leaf)) == 7 and np.allclose(flat["value"][leaf], expected)
    assert [walk(flat, row) for row in x] == leaf.tolist()


def test_one_cut_a_level():
    x, y, cuts = sample(4)
    flat, leaf = one_tree(x, y, cuts, TreeParams(1, 3, 1, 0.5, 3.0, growth="oblivious"))
    by_level = {}
    for node, path in enumerate(flat["path"]):
        if flat["feature"][node] >= 0:
            by_level.setdefault(int(path).bit_length(), set()).add((int(flat["feature"][node]), float(flat["threshold"][node])))
    assert len(by_level) == 3 and all(len(s) == 1 for s in by_level.values())
    best = -np.inf
    for f in range(x.shape[1]):
        for low in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= low
            sums = [(y[s].sum(), s.sum()) for s in (left, ~left)]
            dot, norm = sum(g * g / (n + 3) for g, n in sums), sum(n * (g / (n + 3)) ** 2 for g, n in sums)
            if dot / math.sqrt(norm) > best + 1e-9:
                best, where = dot / math.sqrt(norm), (f, low)
    assert flat["feature"][0] == where[0] and where[1] < flat["threshold"][0]
    assert [walk(flat, row) for row in x] == leaf.tolist()


def test_boosting_by_hand():
    x, y, cuts = sample(5)
    p = TreeParams(4, 2, 1, 0.3, 1.0)
    model = T.fit_series(cuts.bins(x), np.arange(len(y)), y, cuts, p, 0, 4)
    pred = np.full(len(y), y.mean())
    for _ in range(4):
        pred += 0.3 * exhaustive(x, y - pred, 2, 1.0, 1)
    assert np.allclose(T.predicted(pd.DataFrame([model]), x), pred)


# ---------------------------------------------------------------- Spark
def panel(spark, n=260, stations=("s1", "s2"), seed=6):
    r = np.random.RandomState(seed)
    frames = []
    for k, s in enumerate(stations):
        x = r.randint(0, 30, (n, 3)) / 7
        frames.append(pd.DataFrame(x, columns=FEATURES).assign(station_id=s, horizon=1, idx=np.arange(n), y=x[:, 0] * (k + 1) - x[:, 1] ** 2 + r.randn(n) / 5,
                                                               date=pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), "h")))
    pdf = pd.concat(frames)
    pdf.loc[(pdf.station_id == "s1") & (pdf.idx == 3), "b"] = None
    return spark.createDataFrame(pdf).selectExpr("station_id", "cast(horizon as int) horizon", "idx", "y", "to_timestamp_ntz(date) date", "a",
                                                 "case when isnan(b) then null else b end b", "c")


PARAMS = {
    "forest": TreeParams(7, 5, 2, bootstrap=True, parts=3),
    "extra": TreeParams(6, 5, 2, random_cuts=True, parts=2),
    "boosted": TreeParams(7, 3, 1, 0.2, 1.0, 0.8, 0.7),
    "leaf": TreeParams(5, 6, 3, 0.2, growth="leaf", leaves=6),
    "oblivious": TreeParams(4, 3, 1, 0.3, 3.0, growth="oblivious"),
}


@pytest.mark.parametrize("name", list(PARAMS))
def test_level_jobs_grow_the_same_trees_as_tasks(spark, monkeypatch, name):
    monkeypatch.setattr(T, "BLOCK_ROWS", 64)
    p, rows = PARAMS[name], panel(spark)
    cuts = T.cut_values(rows.dropna(), FEATURES, T.KEYS)
    blocks = T.binned_blocks(rows, FEATURES, T.KEYS, cuts)
    assert blocks.count() == 10 and {r.n for r in cuts.collect()} == {259, 260}
    out = []
    for limit in (T.TASK_ROWS, 259):  # s2 is longer than 259 rows
        monkeypatch.setattr(T, "TASK_ROWS", limit)
        monkeypatch.setattr(T, "ROUNDS_KEPT", 3)
        monkeypatch.setattr(T, "TREES_TOGETHER", 4)
        models = T.fit_trees(blocks, cuts, p, T.KEYS)
        got = T.predict_trees(rows, models, FEATURES, T.KEYS, ["idx", "y"]).orderBy("station_id", "idx").toPandas()
        assert len(got) == 519
        out.append(got)
    assert np.allclose(out[0].yhat, out[1].yhat)
    assert out[0].groupby("station_id").apply(lambda g: np.corrcoef(g.y, g.yhat)[0, 1], include_groups=False).min() > 0.6


def test_long_series_grow_the_same_trees_of_random_cuts_as_tasks(spark, monkeypatch):
    p, rows = PARAMS["extra"], panel(spark)
    cuts = T.cut_values(rows.dropna(), FEATURES, T.KEYS)
    blocks = T.binned_blocks(rows, FEATURES, T.KEYS, cuts)
    out = []
    for limit in (T.DRAWN_ROWS, 259):  # s2 is longer than 259 rows
        monkeypatch.setattr(T, "DRAWN_ROWS", limit)
        assert T.task_rows(p) == limit and T.task_rows(PARAMS["forest"]) == T.TASK_ROWS
        models = T.fit_trees(blocks, cuts, p, T.KEYS)
        out.append(T.predict_trees(rows, models, FEATURES, T.KEYS, ["idx", "y"]).orderBy("station_id", "idx").toPandas())
    assert len(out[0]) == 519 and np.allclose(out[0].yhat, out[1].yhat)


def test_a_series_without_rows_has_no_model(spark):
    rows = panel(spark).filter("idx < 0")
    cuts = T.cut_values(rows, FEATURES, T.KEYS)
    blocks = T.binned_blocks(rows, FEATURES, T.KEYS, cuts)
    assert T.fit_trees(blocks, cuts, PARAMS["boosted"], T.KEYS).count() == 0


# ---------------------------------------------------------------- attributions
def subset_value(flat, root, x, known):
    f = flat["feature"][root]
    if f < 0:
        return flat["value"][root]
    left = flat["left"][root]
    if f in known:
        return subset_value(flat, left + (x[f] > flat["threshold"][root]), x, known)
    cover = flat["cover"]
    return sum(cover[c] * subset_value(flat, c, x, known) for c in (left, left + 1) if cover[c]) / (cover[left] + cover[left + 1])


@pytest.mark.parametrize("p", [TreeParams(3, 5, 2, bootstrap=True), TreeParams(4, 4, 1, 0.3, 1.0), TreeParams(3, 4, 1, 0.3, 3.0, growth="oblivious")])
def test_attributions_against_all_subsets(p):
    x, y, cuts = sample(7, n=90, f=6)
    model = T.fit_series(cuts.bins(x), np.arange(len(y)), y, cuts, p, 0, p.trees)
    models, rows = pd.DataFrame([model]), x[:5]
    phi, mean = EX.tree_attributions(models, rows)
    assert np.allclose(phi.sum(axis=1) + mean, T.predicted(models, rows))
    flat = {k: np.asarray(model[k]) for k in ("feature", "threshold", "left", "value", "cover")}
    for i, row in enumerate(rows):
        expected = np.zeros(6)
        for f in range(6):
            others = [k for k in range(6) if k != f]
            for size in range(6):
                for known in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(5 - size) / math.factorial(6)
                    for root in model["root"]:
                        expected[f] += weight * model["scale"] * (subset_value(flat, root, row, {*known, f}) - subset_value(flat, root, row, set(known)))
        assert np.allclose(phi[i], expected)


def test_bijection_of_every_size():
    for n in [*range(1, 140), 1_000, 4_097]:
        assert sorted(EX.permuted(np.arange(n), n, 1, 2).tolist()) == list(range(n))
    a, b = (EX.permuted(np.arange(1_000), 1_000, rep, 5) for rep in (0, 1))
    assert (a != b).mean() > 0.99 and abs(np.corrcoef(a, np.arange(1_000))[0, 1]) < 0.1


def test_permutation_importance_of_trees(spark):
    rows, p = panel(spark).dropna().filter("idx >= 4"), PARAMS["boosted"]
    cuts = T.cut_values(rows, FEATURES, T.KEYS)
    models = T.fit_trees(T.binned_blocks(rows, FEATURES, T.KEYS, cuts), cuts, p, T.KEYS).cache()
    got = EX.importance_of(rows, models, FEATURES, T.predicted, repeats=3).toPandas()
    pdf = rows.orderBy("idx").toPandas()
    for s in ("s1", "s2"):
        d = pdf[pdf.station_id == s]
        m = models.filter(f"station_id = '{s}'").toPandas()
        x, y = d[FEATURES].to_numpy(float), d.y.to_numpy()
        r2 = lambda z: 1 - ((T.predicted(m, z) - y) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        for j, f in enumerate(FEATURES):
            drops = []
            for rep in range(3):
                z = x.copy()
                z[EX.permuted(np.arange(len(y)), len(y), rep, j), j] = x[:, j]
                drops.append(r2(x) - r2(z))
            row = got[(got.station_id == s) & (got.feature == f)].iloc[0]
            assert np.isclose(row.importance_mean, np.mean(drops)) and np.isclose(row.importance_std, np.std(drops))


# ---------------------------------------------------------------- tuning
def test_tuning_against_direct_folds(spark, monkeypatch):
    rows = panel(spark, n=70).dropna().withColumn("idx", F.when(F.col("station_id") == "s1", F.when(F.col("idx") > 3, F.col("idx") - 1).otherwise(F.col("idx"))).otherwise(F.col("idx")))
    preset, grid = dict(trees=5, depth=2, rate=0.3, l2=1.0, min_leaf=1), [{"depth": 1}, {"depth": 4, "rate": 0.2}]
    pdf = rows.toPandas()
    expected = {}
    for s, d in pdf.groupby("station_id"):
        d = d.sort_values("idx")
        x, y, n = d[FEATURES].to_numpy(float), d.y.to_numpy(), len(d)
        size, cuts, scores = n // 3, Cuts([np.unique(x[:, j]) for j in range(3)]), []
        for point in grid:
            p, fold = TreeParams(**(preset | point)), []
            for i in range(2):
                start = n - (2 - i) * size
                m = T.fit_series(cuts.bins(x[:start]), np.arange(start), y[:start], cuts, p, 0, p.trees)
                fold.append(np.abs(T.predicted(pd.DataFrame([m]), x[start:start + size]) - y[start:start + size]).mean())
            scores.append(np.mean(fold))
        expected[s] = (int(np.argmin(scores)), min(scores))
    for limit in (T.TASK_ROWS, 10):
        monkeypatch.setattr(T, "TASK_ROWS", limit)
        got = {r.station_id: r for r in T.tune_trees(rows, preset, grid, FEATURES, T.KEYS, k=2).collect()}
        assert {s: r.param_id for s, r in got.items()} == {s: e[0] for s, e in expected.items()}
        assert all(np.isclose(got[s].cv_mae, e[1]) for s, e in expected.items())


def test_grids_of_boosted_models():
    from hourcast.plans.models import tree_grid
    for name in ("XGBoost", "LightGBM"):
        points = tree_grid(name)
        assert len(points) == 16 and all(p["depth"] > 0 for p in points) and [T.params_of(name, **p) for p in points]

"""Explainability of per-series models.

Linear Shapley values are exact: phi_j = w_j (x_j - mean_j), with the mean
over the series' train rows; they add up to yhat - E[yhat].  Permutation
importance shuffles one feature at a time inside each series' test rows
and measures the drop in R2: by a random order per (repeat, feature) for linear
models, by a keyed bijection of row numbers for any model.  Tree ensembles have
path-dependent Shapley values.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.operators import trees as T
from hourcast.operators.metrics import r2_expr

KEYS = ["station_id", "horizon"]


def _x(features):
    return F.array(*[F.col(c).cast("double") for c in features])


def shapley_linear(rows: DataFrame, train: DataFrame, coefs: DataFrame, features: list[str]) -> DataFrame:
    """Long (keys, date, feature, phi) for every row of ``rows``."""
    means = train.groupBy(*KEYS).agg(F.array(*[F.avg(c) for c in features]).alias("_mu"))
    names = F.array(*[F.lit(c) for c in features])
    j = rows.select(*KEYS, "date", _x(features).alias("_x")).join(coefs.select(*KEYS, "coef"), KEYS).join(means, KEYS)
    phi = F.zip_with(F.zip_with("coef", "_x", lambda w, x: F.struct(w.alias("w"), x.alias("x"))), "_mu",
                     lambda wx, m: wx["w"] * (wx["x"] - m))
    return j.select(*KEYS, "date", F.inline(F.arrays_zip(names.alias("feature"), phi.alias("phi"))))


def shapley_summary(phi: DataFrame, top_n: int = C.TOP_N_FEATURES) -> DataFrame:
    """Mean |phi| per feature, top ``top_n`` per series."""
    s = phi.groupBy(*KEYS, "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.partitionBy(*KEYS).orderBy(F.col("mean_abs_phi").desc(), "feature")
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


def shapley_extreme_row(rows: DataFrame, train: DataFrame, coefs: DataFrame, features: list[str]) -> DataFrame:
    """Attributions of the row with the highest actual value per series (the
    first of equal ones): the row is chosen first, then explained alone."""
    row = F.struct("date", *features)
    top = rows.groupBy(*KEYS).agg(F.min_by(row, F.struct(-F.col("y"), F.col("date"))).alias("_r")).select(*KEYS, "_r.*")
    return shapley_linear(top, train, coefs, features)


def permutation_importance(test: DataFrame, coefs: DataFrame, features: list[str],
                           repeats: int = C.PERMUTATION_REPEATS, seed: int = C.RANDOM_SEED,
                           top_n: int = C.TOP_N_FEATURES) -> DataFrame:
    """Mean and std (population) over repeats of R2(original) - R2(feature shuffled)."""
    base = test.select(*KEYS, "date", "y", *features).join(coefs.select(*KEYS, "intercept", "coef"), KEYS)
    dot = F.aggregate(F.zip_with("coef", _x(features), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    base = base.withColumn("yhat", F.col("intercept") + dot)
    e0 = F.col("yhat") - F.col("y")
    r2_0 = base.groupBy(*KEYS).agg(r2_expr(F.sum(e0 * e0), F.var_pop("y") * F.count("y")).alias("r2_0"))
    reps = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("rep")
    feats = F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("fi")
    x = base.select(*KEYS, "date", "y", "yhat", "coef", _x(features).alias("_x"), reps).select("*", feats)
    # random order per (repeat, feature) from a seeded hash (stable under recomputation)
    u = F.xxhash64("date", "rep", "fi", F.lit(seed))
    w_pos = Window.partitionBy(*KEYS, "rep", "fi").orderBy("date")
    w_rnd = Window.partitionBy(*KEYS, "rep", "fi").orderBy(u, "date")
    x = x.withColumn("_i", F.row_number().over(w_pos)).withColumn("_k", F.row_number().over(w_rnd))
    src = x.select(*KEYS, "rep", "fi", F.col("_k").alias("_i"), F.element_at("_x", F.col("fi") + 1).alias("_xs"))
    j = x.join(src, KEYS + ["rep", "fi", "_i"])
    wf = F.element_at("coef", F.col("fi") + 1)
    yp = F.col("yhat") + wf * (F.col("_xs") - F.element_at("_x", F.col("fi") + 1))
    e = yp - F.col("y")
    r2 = j.groupBy(*KEYS, "rep", "fi").agg(r2_expr(F.sum(e * e), F.var_pop("y") * F.count("y")).alias("r2"))
    drop = r2.join(r2_0, KEYS).withColumn("drop", F.col("r2_0") - F.col("r2"))
    names = F.array(*[F.lit(c) for c in features])
    out = drop.groupBy(*KEYS, "fi").agg(F.avg("drop").alias("importance_mean"),
                                        F.stddev_pop("drop").alias("importance_std"))
    out = out.withColumn("feature", F.element_at(names, F.col("fi") + 1)).drop("fi")
    w = Window.partitionBy(*KEYS).orderBy(F.col("importance_mean").desc(), "feature")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)

# ---------------------------------------------------------------- trees
#: Points and weights in (0, 1) that integrate polynomials up to degree 2 x 8 - 1 exactly: paths of up to 16 features.
_AT, _WEIGHT = np.polynomial.legendre.leggauss(8)
_AT, _WEIGHT = (_AT + 1) / 2, _WEIGHT / 2


def tree_paths(m: dict) -> list[tuple[np.ndarray, list[list[tuple[float, bool]]], np.ndarray, float]]:
    """For every leaf of a model part: the features on its path, their conditions (threshold, above), the share of
    training rows that follow the path at all nodes of each feature, and the leaf's value."""
    out = []
    for root in m["root"]:
        todo = [(int(root), {})]
        while todo:
            node, path = todo.pop()
            f = int(m["feature"][node])
            if f < 0:
                if m["value"][node] != 0 and path:
                    out.append((np.array(list(path)), [c for c, _ in path.values()], np.array([z for _, z in path.values()]), float(m["value"][node])))
                continue
            for side in (0, 1):
                child = int(m["left"][node]) + side
                share = m["cover"][child] / m["cover"][node] if m["cover"][node] > 0 else 0.0
                if share <= 0:
                    continue  # no training row goes there, so its value is 0
                conditions, z = path.get(f, ([], 1.0))
                todo.append((child, path | {f: ([*conditions, (float(m["threshold"][node]), bool(side))], z * share)}))
    return out


def tree_attributions(models: pd.DataFrame, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values [row, feature] of path-dependent expectations, and the mean that they start from.

    A leaf's game is a product over its path's features: one if the feature is known and its conditions hold, zero if
    known and they don't, its training share if unknown. The average of such a product over all orders is an integral
    over (0, 1) of a polynomial, which a few points give exactly; a path of d features costs d times 8 products for
    each row instead of 2^d subsets."""
    phi, mean = np.zeros(x.shape), float(models["base"].max())
    for m in models.to_dict("records"):
        m |= {k: np.asarray(m[k]) for k in ("root", "feature", "threshold", "left", "value", "cover")}
        mean += m["scale"] * sum(_expected(m, int(r)) for r in m["root"])
        for features, conditions, share, value in tree_paths(m):
            holds = np.ones((len(x), len(features)), bool)
            for i, (f, some) in enumerate(zip(features, conditions)):
                for threshold, above in some:
                    holds[:, i] &= (x[:, f] > threshold) == above
            factor = share[None, :, None] * (1 - _AT) + holds[:, :, None] * _AT
            others = factor.prod(axis=1)[:, None, :] / factor
            phi[:, features] += m["scale"] * value * (holds - share) * (others @ _WEIGHT)
    return phi, mean


def _expected(m: dict, root: int) -> float:
    """Mean of a tree's leaf values over its training rows."""
    if m["feature"][root] < 0:
        return float(m["value"][root])
    left, cover = int(m["left"][root]), m["cover"]
    total = cover[left] + cover[left + 1]
    return sum(float(cover[c] / total) * _expected(m, c) for c in (left, left + 1) if cover[c] > 0) if total > 0 else 0.0


def shapley_trees(rows: DataFrame, models: DataFrame, features: list[str]) -> DataFrame:
    """Long (keys, date, feature, phi) of tree ensembles for every row of ``rows``."""
    def run(m, r, x):
        return r.assign(phi=list(tree_attributions(m, x)[0]))

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in (*KEYS, "date"))
    values = T.by_block(rows, models, features, KEYS, ["date"], run, f"{kinds}, phi array<double>")
    names = F.array(*[F.lit(c) for c in features])
    return values.select(*KEYS, "date", F.inline(F.arrays_zip(names.alias("feature"), F.col("phi").alias("phi"))))


def extreme_rows(rows: DataFrame, features: list[str], position: str = "idx") -> DataFrame:
    """Each series' row of the highest actual value (the first of equal ones)."""
    row = F.struct("date", position, *features)
    return rows.groupBy(*KEYS).agg(F.min_by(row, F.struct(-F.col("y"), F.col("date"))).alias("_r")).select(*KEYS, "_r.*")


# ---------------------------------------------------------------- permutation importance of any model
def permuted(place: np.ndarray, n: int, *draw: int) -> np.ndarray:
    """Where a random bijection of 0..n-1 sends each place: four Feistel rounds on the halves of the next power of
    four, walked on until the result is below n."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    at = np.asarray(place).astype(np.uint64)
    todo = np.arange(len(at))
    while len(todo):
        left, right = at[todo] >> np.uint64(half), at[todo] & mask
        for round_ in range(4):
            key = (T.uniform(4, *draw, round_, right) * float(1 << half)).astype(np.uint64)
            left, right = right, left ^ key
        at[todo] = (left << np.uint64(half)) | right
        todo = todo[at[todo] >= n]
    return at.astype(np.int64)


def importance_of(test: DataFrame, models: DataFrame, features: list[str], predict, repeats: int = C.PERMUTATION_REPEATS,
                  top_n: int = C.TOP_N_FEATURES, position: str = "idx") -> DataFrame:
    """Mean and population deviation over repeats of R2(rows) - R2(rows with one feature shuffled within the series).

    ``predict(model rows, features)`` scores a block. A block sends each of its values once per repeat and feature to
    the block of the row that gets it, packed by target block; a target block then holds, for all repeats and
    features, one value per row, and no feature vector is copied. Rows with a null feature or target are left out;
    ``position`` numbers a series' test rows without gaps."""
    d = test.dropna(subset=[*features, "y"])
    size = d.groupBy(*KEYS).agg(F.min(position).alias("_low"), F.count(F.lit(1)).alias("_n"))
    d = d.join(size, KEYS).withColumn("_at", (F.col(position) - F.col("_low")).cast("long"))
    kinds = ", ".join(f"`{k}` {d.schema[k].dataType.simpleString()}" for k in KEYS)
    cols = [F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(features)]
    rows = d.select(*KEYS, "_at", "_n", F.floor(F.col("_at") / T.BLOCK_ROWS).alias("_blk"), F.col("y").cast("double").alias("y"), *cols)
    names = [f"_x{j}" for j in range(len(features))]

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        own, n, at, out = {k: pdf[k].iloc[0] for k in KEYS}, int(pdf["_n"].iloc[0]), pdf["_at"].to_numpy(), []
        for rep in range(repeats):
            for j, c in enumerate(names):
                to = permuted(at, n, rep, j)
                block, values = to // T.BLOCK_ROWS, pdf[c].to_numpy()
                for b in np.unique(block):
                    on = block == b
                    out.append({**own, "_blk": int(b), "rep": rep, "fi": j, "at": to[on].tobytes(), "x": values[on].tobytes()})
        return pd.DataFrame(out)

    sent = rows.groupBy(*KEYS, "_blk").applyInPandas(send, f"{kinds}, _blk long, rep int, fi int, at binary, x binary")
    heads = rows.select(*KEYS, "_blk").distinct().join(models, KEYS)
    heads = heads.withColumn("rep", F.lit(-1))
    # models and shuffled values of a block come as one side, its rows as the other
    side = sent.unionByName(heads, allowMissingColumns=True)
    side = side.toDF(*[f"_{c}" if c in (*KEYS, "_blk") else c for c in side.columns])

    def score(s: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out, head = [], s[s["rep"] < 0]
        columns = [*KEYS, "rep", "fi", "n", "sy", "syy", "sse"]
        if not len(r) or not len(head):
            return pd.DataFrame(columns=columns)
        r = r.sort_values("_at")
        x, y, at = r[names].to_numpy(float), r["y"].to_numpy(float), r["_at"].to_numpy()
        model = head.drop(columns=["rep", "fi", "at", "x"]).dropna(axis=1, how="all")
        one = {k: r[k].iloc[0] for k in KEYS} | {"n": len(y), "sy": y.sum(), "syy": (y * y).sum()}
        out.append(one | {"rep": -1, "fi": -1, "sse": ((predict(model, x) - y) ** 2).sum()})
        for (rep, j), some in s[s["rep"] >= 0].groupby(["rep", "fi"]):
            to = np.concatenate([np.frombuffer(b, np.int64) for b in some["at"]])
            values = np.concatenate([np.frombuffer(b) for b in some["x"]])
            column = x[:, int(j)].copy()
            x[np.searchsorted(at, to), int(j)] = values
            out.append(one | {"rep": int(rep), "fi": int(j), "sse": ((predict(model, x) - y) ** 2).sum()})
            x[:, int(j)] = column
        return pd.DataFrame(out, columns=columns)

    side, rows = T.spread(side, *[f"_{k}" for k in KEYS], "__blk"), T.spread(rows, *KEYS, "_blk")
    parts = side.groupBy(*[f"_{k}" for k in KEYS], "__blk").cogroup(rows.groupBy(*KEYS, "_blk")).applyInPandas(
        score, f"{kinds}, rep int, fi int, n long, sy double, syy double, sse double")
    total = parts.groupBy(*KEYS, "rep", "fi").agg(*[F.sum(c).alias(c) for c in ("n", "sy", "syy", "sse")])
    r2 = total.select(*KEYS, "rep", "fi", r2_expr(F.col("sse"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")).alias("r2"))
    drop = r2.filter("rep >= 0").join(r2.filter("rep < 0").select(*KEYS, F.col("r2").alias("r2_0")), KEYS).withColumn("drop", F.col("r2_0") - F.col("r2"))
    out = drop.groupBy(*KEYS, "fi").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
    out = out.withColumn("feature", F.element_at(F.array(*[F.lit(c) for c in features]), F.col("fi") + 1)).drop("fi")
    w = Window.partitionBy(*KEYS).orderBy(F.col("importance_mean").desc(), "feature")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


def predict_coefficients(models: pd.DataFrame, x: np.ndarray) -> np.ndarray:
    """Predictions of a row of ``fit_linear``'s coefficient table."""
    return float(models["intercept"].iloc[0]) + x @ np.asarray(models["coef"].iloc[0], float)

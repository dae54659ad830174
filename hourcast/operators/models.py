"""Forecasting models.

Linear family (OLS, ridge, elastic net, window ridge, DLinear/NLinear,
Fourier regression, ARMA-error regression) is fitted *per series* from
sufficient statistics: every task adds up the augmented Gram matrix
G = sum [1, x, y][1, x, y]^T of its rows per key (numpy inside the task), the
partials are summed by a small shuffle on (key, i, j), and each key's
(p+2)x(p+2) matrix is solved in one grouped pandas call.  One pass over the
data, no per-station driver loop, no group ever collected into one task.
Predictions are column expressions (coefficients joined by key).

Tree ensembles are in ``trees.py``.
"""
from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY

COEF_SCHEMA_KEYS = {"station_id": "string", "horizon": "int", "mode": "string", "fold": "int", "alpha": "double",
                    "model": "string", "seg": "int", "window": "int"}


def _key_schema(keys):
    return ", ".join(f"`{k}` {COEF_SCHEMA_KEYS.get(k, 'string')}" for k in keys)


#: Keys whose matrices a task holds before it passes on those of the oldest.
HELD_KEYS = 256


def gram(df: DataFrame, features, keys: list[str], y: str = "y") -> DataFrame:
    """Partial augmented Gram matrices: (keys..., g) with the packed upper
    triangle of sum a a^T over a = [1, x_1..x_p, y], one row per key and task
    (a task that meets more than HELD_KEYS keys may pass on a key again).
    ``features`` is a list of columns or ("array_column", p) for a fixed-length
    array feature."""
    arr = features if isinstance(features, tuple) else None
    p = arr[1] if arr else len(features)
    names = list(keys)
    cols = names + ([arr[0]] if arr else list(features)) + [y]
    upper = np.triu_indices(p + 2)

    def partial(batches):
        held = {}

        def rows(some):
            data = {k: [kv[i] for kv in some] for i, k in enumerate(names)}
            return pd.DataFrame(data | {"g": [held.pop(kv)[upper] for kv in some]})

        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[arr[0]].to_numpy()).astype(float) if arr else pdf[list(features)].to_numpy(dtype=float)
            a = np.column_stack([np.ones(len(pdf)), x, pdf[y].to_numpy(dtype=float)])
            for kv, at in pdf.groupby(names, sort=False, dropna=False).indices.items():
                kv = kv if isinstance(kv, tuple) else (kv,)
                m = a[at].T @ a[at]
                held[kv] = held.pop(kv) + m if kv in held else m
            if len(held) > HELD_KEYS:
                yield rows(list(held)[:len(held) - HELD_KEYS])
        if held:
            yield rows(list(held))

    return df.select(*cols).dropna().mapInPandas(partial, f"{_key_schema(keys)}, g array<double>")


def _dense(pdf: pd.DataFrame, p: int) -> np.ndarray:
    """The full matrix of a key: the sum of its packed partials."""
    g = np.zeros((p + 2, p + 2))
    g[np.triu_indices(p + 2)] = np.sum(pdf["g"].tolist(), axis=0)
    return g + np.triu(g, 1).T


def _moments(g: np.ndarray):
    n = g[0, 0]
    sx, sy = g[0, 1:-1], g[0, -1]
    mx, my = sx / n, sy / n
    sxx = g[1:-1, 1:-1] - n * np.outer(mx, mx)
    sxy = g[1:-1, -1] - n * mx * my
    return n, mx, my, sxx, sxy


def solve_ridge(g: np.ndarray, alpha: float, standardize: bool = True):
    """StandardScaler (population std) + Ridge(alpha) with intercept, or OLS
    when alpha = 0 (minimum-norm least squares)."""
    n, mx, my, sxx, sxy = _moments(g)
    sd = np.sqrt(np.clip(np.diag(sxx) / n, 0, None)) if standardize else np.ones(len(mx))
    sd = np.where(sd > 0, sd, 1.0)
    zz = sxx / np.outer(sd, sd)
    zy = sxy / sd
    a = zz + alpha * np.eye(len(mx))
    w_std = np.linalg.lstsq(a, zy, rcond=None)[0] if alpha == 0 else np.linalg.solve(a, zy)
    w = w_std / sd
    return float(my - mx @ w), w


def solve_elastic_net(g: np.ndarray, alpha: float, l1_ratio: float, max_iter: int = C.ELASTIC_NET_MAX_ITER,
                      tol: float = 1e-9):
    """StandardScaler + ElasticNet: min 1/(2n)|y - Zw - b|^2 + a*l1*|w|_1 +
    a*(1-l1)/2*|w|^2 on the covariance form, by feature-sign search: the zero
    coefficient that violates optimality most becomes active, the active ones'
    linear system is solved, and on the way there the best point among the sign
    changes is taken.  Each step lowers the objective, so the exact optimum is
    reached.  Returns (intercept, weights, converged)."""
    n, mx, my, sxx, sxy = _moments(g)
    sd = np.sqrt(np.clip(np.diag(sxx) / n, 0, None))
    used = sd > 1e-12 * max(1.0, float(np.abs(mx).max(initial=0)))
    sd = np.where(used, sd, 1.0)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    h = sxx / np.outer(sd, sd) / n + l2 * np.eye(len(sd))
    c = np.where(used, sxy / sd / n, 0.0)
    slack = tol * max(1.0, float(np.abs(c).max(initial=0)))
    w, converged = np.zeros(len(c)), False

    def value(v):
        return 0.5 * v @ h @ v - c @ v + l1 * np.abs(v).sum()

    for _ in range(max_iter):
        pull = c - h @ w
        on = np.flatnonzero(w)
        sign = np.sign(w)
        settled = not len(on) or np.abs(pull[on] - l1 * sign[on]).max() <= slack
        if settled:
            off = np.flatnonzero(used & (w == 0))
            if not len(off) or np.abs(pull[off]).max() <= l1 + slack:
                converged = True
                break
            j = off[np.argmax(np.abs(pull[off]))]
            sign[j] = np.sign(pull[j])
            on = np.sort(np.append(on, j))
        goal = np.zeros_like(w)
        goal[on] = np.linalg.lstsq(h[np.ix_(on, on)], c[on] - l1 * sign[on], rcond=None)[0]
        step = goal - w
        cross = on[(w[on] != 0) & (np.sign(goal[on]) != sign[on])]
        points = [goal]
        for j in cross:
            at = w - w[j] / step[j] * step
            at[j] = 0.0
            points.append(at)
        best = min(points, key=value)
        if value(best) >= value(w) - 1e-16 * max(1.0, abs(value(w))) and settled is False:
            break  # no further progress in double precision
        w = np.where(np.abs(best) > 1e-14, best, 0.0)
    w = w / sd
    return float(my - mx @ w), w, converged


def _solved(g: np.ndarray, kind: str, params: dict):
    """(intercept, weights, converged) of one parameter point."""
    if kind == "elastic_net":
        return solve_elastic_net(g, params["alpha"], params.get("l1_ratio", 0.2))
    b, w = solve_ridge(g, 0.0 if kind == "ols" else params["alpha"])
    return b, w, True


def fit_linear(df: DataFrame, features: list[str], keys=(KEY, "horizon"), kind: str = "ridge",
               alpha: float = 1.0, l1_ratio: float = 0.2) -> DataFrame:
    """Per-key linear fit: (keys..., intercept, coef array<double>, converged)."""
    return fit_linear_grid(df, features, keys, kind, [{"alpha": alpha, "l1_ratio": l1_ratio}]).drop("param_id", "params")


_NOT_KEYS = ("intercept", "coef", "converged", "train_rows")


def predict_linear(df: DataFrame, coefs: DataFrame, features: list[str], out: str = "yhat") -> DataFrame:
    """yhat = intercept + sum_i coef[i] * x_i, coefficients joined by key."""
    keys = [k for k in coefs.columns if k not in _NOT_KEYS and k in df.columns]
    x = F.col(features[0]) if isinstance(features, tuple) else F.array(*[F.col(c).cast("double") for c in features])
    dot = F.aggregate(F.zip_with("coef", x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    return df.join(coefs, keys).withColumn(out, F.col("intercept") + dot).drop(*_NOT_KEYS)


# ---------------------------------------------------------------- window models
def transform_window(df: DataFrame, kind: str = "window", lookback: int = C.WINDOW_LAGS):
    """Model input array from the lag window: ``window`` as is; ``dlinear``
    moving-average remainder + the average (trend); ``nlinear`` minus the last
    value (which is also subtracted from y and added back to predictions).
    Returns (frame with ``xw`` array, ("xw", length))."""
    if kind == "nlinear":
        last = F.col("window")[0]
        df = df.withColumn("_last", last).withColumn("y", F.col("y") - F.col("_last"))
        return df.withColumn("xw", F.transform("window", lambda x: x - last)), ("xw", lookback)
    if kind == "dlinear":
        ma = F.aggregate("window", F.lit(0.0), lambda a, x: a + x) / F.lit(float(lookback))
        df = df.withColumn("_ma", ma)
        xw = F.concat(F.transform("window", lambda x: x - F.col("_ma")), F.array(F.col("_ma")))
        return df.withColumn("xw", xw).drop("_ma"), ("xw", lookback + 1)
    return df.withColumn("xw", F.col("window")), ("xw", lookback)


# ---------------------------------------------------------------- Fourier / trend regression
def fourier_features(df: DataFrame, time_col: str = "date", yearly: int = 10, weekly: int = 3,
                     n_changepoints: int = 25) -> tuple[DataFrame, list[str]]:
    """Additive trend + yearly/weekly Fourier terms from the true time."""
    from hourcast.operators.series import epoch_hour
    t = epoch_hour(time_col) / F.lit(24.0)
    cols, names = [t.alias("t_days")], ["t_days"]
    if n_changepoints:
        # hinges at equal steps over the first 80% of the common time range
        ends = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
        lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
        for k in range(1, n_changepoints + 1):
            at = lo + (hi - lo) * F.lit(0.8 * k / (n_changepoints + 1))
            cols.append(F.greatest(F.lit(0.0), t - at).alias(f"hinge_{k}"))
            names.append(f"hinge_{k}")
    for period, order, tag in ((365.25, yearly, "y"), (7.0, weekly, "w")):
        for k in range(1, order + 1):
            arg = F.lit(2 * np.pi * k / period) * t
            cols += [F.sin(arg).alias(f"f{tag}_s{k}"), F.cos(arg).alias(f"f{tag}_c{k}")]
            names += [f"f{tag}_s{k}", f"f{tag}_c{k}"]
    return df.select("*", *cols), names


# ---------------------------------------------------------------- ARMA(1,1)-error regression
def arma_regression(train: DataFrame, test: DataFrame, features: list[str], keys=(KEY, "horizon")) -> DataFrame:
    """Regression with ARMA(1,1) errors (Hannan-Rissanen, all steps as Spark
    jobs): (1) y ~ x gives beta, u = y - x beta; (2) AR(24) on u gives the
    innovations e; (3) u ~ u_-1 + e_-1 gives (phi, theta).  The multi-step
    forecast over the adjacent test block is x beta + phi^(k-1) (phi u_T + theta e_T)."""
    from hourcast.operators.series import block_hours, block_window, core_only, epoch_hour, with_halo
    from hourcast.session import materialize
    keys = [k for k in keys if k in train.columns]
    block = block_hours(train)
    beta = fit_linear(train, features, keys, "ols")
    u = predict_linear(train, beta, features, "_xb").withColumn("u", F.col("y") - F.col("_xb"))
    ar = 24
    u = materialize(u.select(*keys, "date", "_pos", "u"), "arma-residuals")
    hx = with_halo(u, ar + 1, 0, block)
    w = block_window(keys)
    lags = [F.lag("u", k).over(w).alias(f"u_l{k}") for k in range(1, ar + 1)]
    ul = core_only(hx.select("*", *lags))
    ar_fit = fit_linear(ul.withColumn("_yy", F.col("u")).select(*keys, *[f"u_l{k}" for k in range(1, ar + 1)],
                                                                 F.col("u").alias("y")),
                        [f"u_l{k}" for k in range(1, ar + 1)], keys, "ols")
    e = predict_linear(ul, ar_fit, [f"u_l{k}" for k in range(1, ar + 1)], "_uhat").withColumn(
        "e", F.col("u") - F.col("_uhat"))
    e = materialize(e.select(*keys, "date", "_pos", "u", "e"), "arma-innovations")
    hx2 = with_halo(e, 1, 0, block)
    w2 = block_window(keys)
    st = core_only(hx2.select("*", F.lag("u", 1).over(w2).alias("u1"), F.lag("e", 1).over(w2).alias("e1")))
    pq = fit_linear(st.select(*keys, "u1", "e1", F.col("u").alias("y")), ["u1", "e1"], keys, "ols")
    pq = pq.select(*keys, F.col("coef")[0].alias("phi"), F.col("coef")[1].alias("theta"))
    last = e.groupBy(*keys).agg(F.max_by(F.struct("u", "e"), "date").alias("_l"), F.max("date").alias("_tmax"))
    xb = predict_linear(test, beta, features, "_xb")
    k = epoch_hour("date") - epoch_hour("_tmax")
    out = xb.join(last, keys).join(pq, keys)
    fc = F.col("_xb") + F.pow(F.col("phi"), k - 1) * (F.col("phi") * F.col("_l.u") + F.col("theta") * F.col("_l.e"))
    return out.withColumn("yhat", fc).drop("_xb", "_l", "_tmax", "phi", "theta")


# ---------------------------------------------------------------- pooled Spark ML model
def spark_ml_linear(features: list[str], reg: float = 0.0, enet: float = 0.0):
    """Pooled Spark ML linear model (for serving / persistence)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"),
                            LinearRegression(featuresCol="features", labelCol="y", predictionCol="yhat",
                                             regParam=reg, elasticNetParam=enet, solver="normal" if enet == 0
                                             else "auto", standardization=True)])


# ---------------------------------------------------------------- grids, tuning, cross-validation
TUNING_GRIDS = {
    # fixed values: the published search spaces
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 5.0, 10.0, 20.0, 30.0, 50.0, 100.0, 200.0]},
    "ElasticNet": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1.0, 10.0, 30.0],
                   "l1_ratio": [0.05, 0.1, 0.2, 0.5, 0.7, 0.9, 0.95]},
    "XGBoost": {"trees": [100, 300, 500, 800], "depth": [3, 4, 5, 6, 7, 8], "rate": [0.01, 0.03, 0.05, 0.1, 0.15],
                "rows": [0.6, 0.7, 0.8, 0.9, 1.0], "columns": [0.6, 0.7, 0.8, 0.9, 1.0]},
    "LightGBM": {"trees": [100, 300, 500, 800], "depth": [3, 4, 5, 6, 7, 8, -1], "rate": [0.01, 0.03, 0.05, 0.1, 0.15],
                 "leaves": [15, 31, 63, 127], "rows": [0.6, 0.7, 0.8, 0.9, 1.0], "columns": [0.6, 0.7, 0.8, 0.9, 1.0]},
    "WindowRidge_168h": {"alpha": [0.01, 0.1, 1.0, 5.0, 10.0, 20.0, 30.0, 50.0, 100.0, 200.0]},
}
N_ITER = 16


def sample_grid(grid: dict, n_iter: int = N_ITER, seed: int = C.RANDOM_SEED) -> list[dict]:
    """Seeded random search: the whole grid when it has <= n_iter points,
    else n_iter distinct points drawn without replacement."""
    import itertools
    names = list(grid)
    points = [dict(zip(names, vals)) for vals in itertools.product(*[grid[n] for n in names])]
    if len(points) <= n_iter:
        return points
    idx = np.random.RandomState(seed).choice(len(points), n_iter, replace=False)
    return [points[i] for i in sorted(idx)]


def fit_linear_grid(df: DataFrame, features: list[str], keys, kind: str, grid: list[dict]) -> DataFrame:
    """One Gram pass, every grid point solved: (keys..., param_id, params, intercept, coef, converged)."""
    keys = [k for k in keys if k in df.columns]
    p = features[1] if isinstance(features, tuple) else len(features)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        g = _dense(pdf, p)
        rows = []
        for pid, prm in enumerate(grid):
            b, w, ok = _solved(g, kind, prm)
            rows.append({**{k: pdf[k].iloc[0] for k in keys}, "param_id": pid,
                         "params": json.dumps(prm), "intercept": b, "coef": w.tolist(), "converged": ok})
        return pd.DataFrame(rows)

    schema = f"{_key_schema(keys)}, param_id int, params string, intercept double, coef array<double>, converged boolean"
    return gram(df, features, keys).groupBy(*keys).applyInPandas(solve, schema)


SCORE_ROWS = 8192


def fold_errors(rows: DataFrame, features: list[str], kind: str, grid: list[dict], keys, k: int) -> DataFrame:
    """Error sums of every grid point on every expanding-window test block:
    (keys..., fold, param_id, n, sae, sse, sy, syy).

    No row is copied per fold: a row belongs to one segment (what precedes the
    first test block, then the test blocks), a fold trains on the prefix sums of
    its segments' Gram matrices, and all grid points of a fold score a chunk of
    its test block in one matrix product."""
    from hourcast.operators.prep import IDX, N, series_index
    keys = [x for x in keys if x in rows.columns]
    p = features[1] if isinstance(features, tuple) else len(features)
    cols = [features[0]] if isinstance(features, tuple) else list(features)
    d = rows if IDX in rows.columns else series_index(rows)
    size = F.floor(F.col(N) / (k + 1))
    first = F.col(N) - size * k
    seg = F.when(F.col(IDX) < first, 0).otherwise(F.floor((F.col(IDX) - first) / size) + 1).cast("int")
    d = d.filter(size > 0).select(*keys, *cols, "y", seg.alias("seg"), F.floor(F.col(IDX) / SCORE_ROWS).cast("int").alias("chunk"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        own, out = {k_: pdf[k_].iloc[0] for k_ in keys}, []
        total = np.zeros((p + 2, p + 2))
        for fold in range(1, k + 1):
            total = total + _dense(pdf[pdf["seg"] == fold - 1], p) if (pdf["seg"] == fold - 1).any() else total
            if total[0, 0] == 0:
                continue
            points = [_solved(total, kind, prm) for prm in grid]
            out.append({**own, "seg": fold, "intercepts": [b for b, _, _ in points], "weights": np.concatenate([w for _, w, _ in points])})
        return pd.DataFrame(out, columns=[*keys, "seg", "intercepts", "weights"])

    fits = (gram(d, features, [*keys, "seg"]).groupBy(*keys)
            .applyInPandas(solve, f"{_key_schema(keys)}, seg int, intercepts array<double>, weights array<double>"))
    test = d.filter("seg > 0").dropna()
    by = [*keys, "seg", "chunk"]
    chunks = test.select(*by).distinct().toDF(*[f"_{c}" for c in by])  # other names than the rows they are matched with
    fits = fits.toDF(*[f"_{c}" if c in by else c for c in fits.columns]).join(chunks, [f"_{c}" for c in (*keys, "seg")])

    def score(f: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "fold", "param_id", "n", "sae", "sse", "sy", "syy"]
        if not len(f) or not len(t):
            return pd.DataFrame(columns=names)
        x = np.stack(t[cols[0]].to_numpy()).astype(float) if isinstance(features, tuple) else t[cols].to_numpy(dtype=float)
        y = t["y"].to_numpy(dtype=float)
        e = x @ np.asarray(f["weights"].iloc[0]).reshape(len(grid), p).T + np.asarray(f["intercepts"].iloc[0]) - y[:, None]
        return pd.DataFrame({**{k_: t[k_].iloc[0] for k_ in keys}, "fold": int(t["seg"].iloc[0]), "param_id": np.arange(len(grid)), "n": len(y),
                             "sae": np.abs(e).sum(0), "sse": (e * e).sum(0), "sy": y.sum(), "syy": (y * y).sum()}, columns=names)

    parts = fits.groupBy(*[f"_{c}" for c in by]).cogroup(test.groupBy(*by)).applyInPandas(
        score, f"{_key_schema(keys)}, fold int, param_id int, n long, sae double, sse double, sy double, syy double")
    return parts.groupBy(*keys, "fold", "param_id").agg(*[F.sum(c).alias(c) for c in ("n", "sae", "sse", "sy", "syy")])


def tune_linear(tune_rows: DataFrame, features: list[str], kind: str, grid: list[dict],
                keys=(KEY, "horizon"), k: int = C.CV_N_SPLITS) -> DataFrame:
    """Expanding-window CV (train on everything before each test block) over
    train+valid rows; score = mean fold MAE; best point per key (first on ties)."""
    keys = [x for x in keys if x in tune_rows.columns]
    errors = fold_errors(tune_rows.drop("idx", "n"), features, kind, grid, keys, k)
    cv = errors.groupBy(*keys, "param_id").agg(F.avg(F.col("sae") / F.col("n")).alias("cv_mae"))
    best = cv.groupBy(*keys).agg(F.min(F.struct("cv_mae", "param_id")).alias("_b")).select(*keys, "_b.param_id", "_b.cv_mae")
    params = F.array(*[F.lit(json.dumps(g)) for g in grid])
    return best.withColumn("params", F.element_at(params, F.col("param_id") + 1))


def cross_validate(rows: DataFrame, features: list[str], kind: str, params: dict, keys=(KEY, "horizon"),
                   k: int = C.CV_N_SPLITS) -> DataFrame:
    """k-fold expanding-window CV: mean and population std over folds of MAE, RMSE, R2."""
    from hourcast.operators.metrics import r2_expr
    keys = [x for x in keys if x in rows.columns]
    s = fold_errors(rows.drop("idx", "n"), features, kind, [params], keys, k)
    spread = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    per = s.select(*keys, "fold", (F.col("sae") / F.col("n")).alias("mae"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                   r2_expr(F.col("sse"), spread).alias("r2"))
    return per.groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in ("mae", "rmse", "r2")
                                    for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))])


# ---------------------------------------------------------------- rolling origins
def rolling_origin_forecasts(windows: DataFrame, features: tuple[str, int], origins: DataFrame, alpha: float = 1.0, keys=(KEY, "horizon")) -> DataFrame:
    """Forecasts of each series at the cut-offs of a rolling-origin backtest: (keys..., window, date, y, yhat).

    ``windows``: rows (keys..., date, y, array feature), where y belongs to date + horizon hours; ``origins``: (station,
    cutoffs), the sorted cut-off times. A cut-off's model may use a row only if its target was known by then. No row is
    copied for a cut-off: a row belongs to the first cut-off that knows its target, and a cut-off trains on the sums of
    the Gram matrices of all segments up to it. The forecast starts from the row at the cut-off itself."""
    keys, (column, p) = list(keys), features
    known = F.col("date") + F.make_dt_interval(hours=F.col("horizon"))
    d = windows.join(origins.select(KEY, "cutoffs"), KEY).select(
        *keys, "date", "y", column, "cutoffs", F.size(F.filter("cutoffs", lambda c: c < known)).alias("seg"))
    train = d.filter(F.col("seg") < F.size("cutoffs")).select(*keys, "seg", column, "y")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out, total = [], np.zeros((p + 2, p + 2))
        for seg in range(int(pdf["n_cutoffs"].iloc[0])):
            own = pdf[pdf["seg"] == seg]
            total = total + _dense(own, p) if len(own) else total
            if total[0, 0] > 0:
                b, w = solve_ridge(total, alpha)
                out.append({**{k: pdf[k].iloc[0] for k in keys}, "window": seg, "intercept": b, "coef": w})
        return pd.DataFrame(out, columns=[*keys, "window", "intercept", "coef"])

    sums = gram(train, features, [*keys, "seg"]).join(origins.select(KEY, F.size("cutoffs").alias("n_cutoffs")), KEY)
    fits = sums.groupBy(*keys).applyInPandas(solve, f"{_key_schema(keys)}, window int, intercept double, coef array<double>")
    at = d.withColumn("window", (F.array_position("cutoffs", F.col("date")) - 1).cast("int")).filter("window >= 0")
    return predict_linear(at.drop("cutoffs", "seg"), fits, features)

"""Per-series linear models against numpy closed forms; Shapley additivity."""
import numpy as np
import pandas as pd

from hourcast.operators import models as M


def _data(spark, n=400, p=5, seed=0):
    rng = np.random.RandomState(seed)
    rows = []
    for s in ("a", "b"):
        x = rng.normal(size=(n, p)) * rng.uniform(0.5, 20, size=p) + rng.uniform(-5, 50, size=p)
        y = x @ rng.normal(size=p) + rng.normal(size=n) * 3 + 7
        for i in range(n):
            rows.append((s, 1, *map(float, x[i]), float(y[i])))
    cols = [f"x{i}" for i in range(p)]
    df = spark.createDataFrame(rows, "station_id string, horizon int, " + ", ".join(f"{c} double" for c in cols)
                               + ", y double")
    return df, cols, pd.DataFrame(rows, columns=["station_id", "horizon", *cols, "y"])


def ridge_ref(x, y, alpha):
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    w = w / sd
    return y.mean() - mu @ w, w


def test_ridge_and_ols_parity(spark):
    df, cols, pdf = _data(spark)
    for kind, alpha in (("ridge", 1.0), ("ridge", 50.0), ("ols", 0.0)):
        got = {r.station_id: r for r in M.fit_linear_grid(df, cols, ["station_id", "horizon"], kind,
                                                          [{"alpha": alpha}]).collect()}
        for s, g in pdf.groupby("station_id"):
            b, w = ridge_ref(g[cols].to_numpy(), g["y"].to_numpy(), alpha)
            np.testing.assert_allclose(got[s].coef, w, rtol=1e-7, atol=1e-9)
            assert abs(got[s].intercept - b) < 1e-6


def test_elastic_net_zero_l1_is_ridge(spark):
    df, cols, pdf = _data(spark, p=3)
    n = 400
    got = {r.station_id: r for r in M.fit_linear_grid(df, cols, ["station_id", "horizon"], "elastic_net",
                                                      [{"alpha": 0.5, "l1_ratio": 0.0}]).collect()}
    for s, g in pdf.groupby("station_id"):
        # alpha*(1-l1)/2 |w|^2 with a 1/(2n) loss is ridge with alpha' = n * alpha
        b, w = ridge_ref(g[cols].to_numpy(), g["y"].to_numpy(), 0.5 * n)
        np.testing.assert_allclose(got[s].coef, w, rtol=1e-3)


def test_linear_shapley_additivity(spark):
    from hourcast.operators.explain import shapley_linear
    df, cols, pdf = _data(spark, n=100)
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rn = F.row_number().over(Window.partitionBy("station_id").orderBy("x0", "x1"))
    df = df.withColumn("date", F.timestamp_seconds(rn * 3600))
    coefs = M.fit_linear_grid(df, cols, ["station_id", "horizon"], "ridge", [{"alpha": 1.0}])
    phi = shapley_linear(df, df, coefs, cols).groupBy("station_id", "date").sum("phi").withColumnRenamed(
        "sum(phi)", "s")
    pred = M.predict_linear(df, coefs.drop("param_id", "params"), cols)
    mean_pred = pred.groupBy("station_id").avg("yhat").withColumnRenamed("avg(yhat)", "m")
    chk = pred.join(phi, ["station_id", "date"]).join(mean_pred, "station_id").toPandas()
    np.testing.assert_allclose(chk["yhat"] - chk["m"], chk["s"], atol=1e-8)


def test_elastic_net_meets_the_optimality_conditions(spark):
    df, cols, pdf = _data(spark, p=6)
    grid = [{"alpha": a, "l1_ratio": r} for a in (0.001, 0.1, 10.0) for r in (0.05, 0.5, 0.95)]
    for got in M.fit_linear_grid(df, cols, ["station_id", "horizon"], "elastic_net", grid).collect():
        g, prm = pdf[pdf.station_id == got.station_id], grid[got.param_id]
        x, y = g[cols].to_numpy(), g["y"].to_numpy()
        z, w = (x - x.mean(0)) / x.std(0), np.array(got.coef) * x.std(0)
        pull = z.T @ (y - y.mean() - z @ w) / len(y) - prm["alpha"] * (1 - prm["l1_ratio"]) * w
        l1 = prm["alpha"] * prm["l1_ratio"]
        assert got.converged
        assert (np.abs(pull[w == 0]) <= l1 + 1e-6).all() and np.allclose(pull[w != 0], l1 * np.sign(w[w != 0]), atol=1e-6)


def test_gram_output_is_one_row_per_key_and_task(spark, monkeypatch):
    df, cols, _ = _data(spark)
    mixed = df.repartition(3)
    parts = M.gram(mixed, cols, ["station_id", "horizon"])
    assert parts.count() <= 2 * 3
    monkeypatch.setattr(M, "HELD_KEYS", 1)
    again = M.fit_linear_grid(mixed, cols, ["station_id", "horizon"], "ols", [{}]).collect()
    first = {r.station_id: r.coef for r in M.fit_linear_grid(df, cols, ["station_id", "horizon"], "ols", [{}]).collect()}
    for r in again:
        np.testing.assert_allclose(r.coef, first[r.station_id], rtol=1e-8)


def test_folds_by_prefix_sums_equal_direct_fits(spark, monkeypatch):
    """Expanding-window CV of a grid against numpy fits on the very rows of each fold."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    monkeypatch.setattr(M, "SCORE_ROWS", 13)
    df, cols, pdf = _data(spark, n=103, p=3)
    order = F.row_number().over(Window.partitionBy("station_id").orderBy("x0", "x1", "x2")) - 1
    df = df.withColumn("idx", order.cast("long")).withColumn("n", F.lit(103).cast("long"))
    grid = [{"alpha": a} for a in (0.1, 10.0, 100.0)]
    errors = M.fold_errors(df, cols, "ridge", grid, ["station_id", "horizon"], 5).collect()
    assert len(errors) == 2 * 5 * 3
    for r in errors:
        g = pdf[pdf.station_id == r.station_id].sort_values(["x0", "x1", "x2"])
        size = 103 // 6
        at = 103 - 5 * size + (r.fold - 1) * size
        b, w = ridge_ref(g[cols].to_numpy()[:at], g["y"].to_numpy()[:at], grid[r.param_id]["alpha"])
        e = g[cols].to_numpy()[at:at + size] @ w + b - g["y"].to_numpy()[at:at + size]
        assert r.n == size and abs(r.sae - np.abs(e).sum()) < 1e-6 and abs(r.sse - (e * e).sum()) < 1e-5


def test_arma_forecast_decays_to_the_regression(spark):
    """y = 2 x + AR(1) noise: the one-step forecast carries the last residual, far ones do not."""
    import datetime as dt
    rng = np.random.RandomState(4)
    n, u, rows = 700, 0.0, []
    for i in range(n):
        u = 0.8 * u + rng.normal()
        x = float(rng.normal())
        rows.append(("a", 1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i, x, 2 * x + u, u))
    df = spark.createDataFrame(rows, "station_id string, horizon int, date timestamp_ntz, _pos long, x double, y double, u double")
    train, test = df.filter("_pos < 600"), df.filter("_pos >= 600")
    got = {r._pos: r.yhat - 2 * r.x for r in M.arma_regression(train, test, ["x"]).collect()}
    last = rows[599][6]
    assert len(got) == 100 and abs(got[600] - 0.8 * last) < 0.35 * max(1, abs(last))
    assert abs(got[699] - got[698]) < 0.05


def test_fourier_terms_and_hinges(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0 + dt.timedelta(hours=i),) for i in range(0, 2400, 24)], "date timestamp_ntz")
    out, names = M.fourier_features(df, n_changepoints=3)
    p = out.orderBy("date").toPandas()
    t = p["t_days"].to_numpy()
    assert len(names) == 1 + 3 + 2 * 13
    np.testing.assert_allclose(p["fw_s1"], np.sin(2 * np.pi * t / 7), atol=1e-9)
    knot = t[0] + (t[-1] - t[0]) * 0.8 * 2 / 4
    np.testing.assert_allclose(p["hinge_2"], np.maximum(0, t - knot), atol=1e-9)


def test_window_transforms(spark):
    df = spark.createDataFrame([([1.0, 2.0, 6.0], 5.0)], "window array<double>, y double")
    d, (c, n) = M.transform_window(df, "dlinear", 3)
    assert d.first()[c] == [-2.0, -1.0, 3.0, 3.0] and n == 4
    d, (c, n) = M.transform_window(df, "nlinear", 3)
    assert d.first()[c] == [0.0, 1.0, 5.0] and d.first().y == 4.0 and n == 3
    d, (c, n) = M.transform_window(df, "window", 3)
    assert d.first()[c] == [1.0, 2.0, 6.0]


def test_pacf_of_an_autoregression(spark):
    from hourcast.operators.eda import pacf
    acf = spark.createDataFrame([("s", k, 0.6**k) for k in range(6)], "station_id string, lag int, acf double")
    got = [r.pacf for r in pacf(acf).orderBy("lag").collect()]
    np.testing.assert_allclose(got, [1.0, 0.6, 0, 0, 0, 0], atol=1e-12)


def test_extreme_row_is_taken_from_the_rows_given(spark):
    from hourcast.operators.explain import shapley_extreme_row
    from pyspark.sql import functions as F
    rows = [("a", 1, 1, 1.0, 5.0), ("a", 1, 2, 3.0, 9.0), ("a", 1, 3, 4.0, 9.0)]
    test = spark.createDataFrame(rows, "station_id string, horizon int, date int, x double, y double")
    train = spark.createDataFrame([("a", 1, 0, 2.0, 99.0)], test.schema)
    coefs = spark.createDataFrame([("a", 1, 0.0, [2.0])], "station_id string, horizon int, intercept double, coef array<double>")
    got = shapley_extreme_row(test, train, coefs, ["x"]).collect()
    assert [(r.date, r.phi) for r in got] == [(2, 2.0)]


def test_package_reaches_workers_of_a_foreign_folder(tmp_path):
    """A session started elsewhere, with the package on the driver's path only."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from hourcast.session import get_session
spark = get_session(master="local[2]", shuffle_partitions=2)
from hourcast.operators import models as M
df = spark.createDataFrame([("a", 1, float(i), 2.0 * i + 1) for i in range(20)], "station_id string, horizon int, x double, y double")
r = M.fit_linear_grid(df, ["x"], ["station_id", "horizon"], "ols", [{{}}]).first()
assert abs(r.intercept - 1) < 1e-9 and abs(r.coef[0] - 2) < 1e-9
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "done" in out.stdout, out.stderr[-1500:]

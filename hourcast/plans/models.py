"""Model benchmark plan: fit/predict every model spec for every
(station, horizon) series of a split table, one long prediction table,
metrics in one aggregation, champion rule, deployable champion."""
from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY
from hourcast.operators import models as M
from hourcast.operators import trees as T
from hourcast.operators.features import window_matrix
from hourcast.operators.metrics import regression_metrics
from hourcast.operators.prep import rolling_origin_windows, train_valid_union
from hourcast.operators.select import select_champion
from hourcast.session import materialize, materialized

KEYS = [KEY, "horizon"]
PRED = [KEY, "horizon", "model", "date", "y", "yhat"]


@dataclass
class ModelSpec:
    """Name, group, complexity rank and a builder (split -> predictions, params)."""
    name: str
    group: str
    complexity_rank: int
    build: object
    tunable: bool = False
    params: dict = field(default_factory=dict)


def _linear(kind, params, features=None):
    features = features or C.FEATURES

    def build(split, tune=False, name=""):
        train = split.filter(F.col("split") == "train")
        test = split.filter(F.col("split") == "test")
        grid = M.sample_grid(M.TUNING_GRIDS[name]) if tune and name in M.TUNING_GRIDS else None
        if grid:
            best = M.tune_linear(train_valid_union(split), features, kind, grid)
            fit_rows = train_valid_union(split)
            coefs = M.fit_linear_grid(fit_rows, features, KEYS, kind, grid)
            coefs = coefs.join(best.select(*KEYS, "param_id"), KEYS + ["param_id"])
            pred = M.predict_linear(test, coefs.drop("param_id"), features)
            return pred.select(*[c for c in PRED if c != "model"], F.col("params").alias("best_params"))
        coefs = M.fit_linear_grid(train, features, KEYS, kind, [params])
        pred = M.predict_linear(test, coefs.drop("param_id", "params"), features)
        return pred.select(*[c for c in PRED if c != "model"], F.lit("").alias("best_params"))
    return build


def _window(kind="window", alpha=1.0):
    def build(split, tune=False, name=""):
        wm, feats = M.transform_window(window_matrix(split), kind)
        wm = wm.drop("window")
        train = wm.filter(F.col("split") == "train")
        test = wm.filter(F.col("split") == "test")
        grid = M.sample_grid(M.TUNING_GRIDS[name]) if tune and name in M.TUNING_GRIDS else [{"alpha": alpha}]
        coefs = M.fit_linear_grid(train, feats, KEYS, "ridge", grid)
        if len(grid) > 1:
            # the window tuner sees train rows only (no validation block passed)
            best = M.tune_linear(train.drop("idx", "n"), feats, "ridge", grid)
            coefs = coefs.join(best.select(*KEYS, "param_id"), KEYS + ["param_id"])
        pred = M.predict_linear(test, coefs.drop("param_id"), feats)
        if kind == "nlinear":
            pred = pred.withColumn("yhat", F.col("yhat") + F.col("_last")).withColumn("y", F.col("y") + F.col("_last"))
        bp = F.col("params") if len(grid) > 1 else F.lit("")
        return pred.select(*[c for c in PRED if c != "model"], bp.alias("best_params"))
    return build


def rolling_origin_metrics(panel: DataFrame, split: DataFrame, kinds=("window", "dlinear", "nlinear"), alpha: float = 1.0) -> DataFrame:
    """(station, window, horizon, model, cutoff, actual, yhat, abs_error): each window model refitted at every cut-off
    of the rolling-origin backtest of the hourly series and held against the value ``horizon`` hours later."""
    tail = rolling_origin_windows(panel.select(KEY, F.col(C.TIME).alias("date"), F.col(C.TARGET).alias("actual")))
    tail = tail.select(KEY, "window", F.col("forecast_horizon").alias("horizon"), "actual",
                       (F.col("date") - F.make_dt_interval(hours=F.col("forecast_horizon"))).alias("cutoff"))
    origins = tail.groupBy(KEY).agg(F.array_sort(F.collect_set("cutoff")).alias("cutoffs"))  # six at most
    out = None
    for kind in kinds:
        wm, feats = M.transform_window(window_matrix(split), kind)
        shift = [F.col("_last")] if kind == "nlinear" else [F.lit(0.0).alias("_last")]
        pred = M.rolling_origin_forecasts(wm.select(*KEYS, "date", "y", feats[0]), feats, origins, alpha)
        pred = pred.join(wm.select(*KEYS, "date", *shift), [*KEYS, "date"]).withColumn("yhat", F.col("yhat") + F.col("_last"))
        got = tail.join(pred.select(*KEYS, F.col("date").alias("cutoff"), "yhat"), [*KEYS, "cutoff"])
        name = {"window": "WindowRidge_168h", "dlinear": "DLinear", "nlinear": "NLinear"}[kind]
        got = got.select(*KEYS, "window", F.lit(name).alias("model"), "cutoff", "actual", "yhat", F.abs(F.col("yhat") - F.col("actual")).alias("abs_error"))
        out = got if out is None else out.unionByName(got)
    return out


def _fourier(alpha=1.0):
    def build(split, tune=False, name=""):
        df, names = M.fourier_features(split)
        feats = names + C.FEATURES
        df = df.withColumn("xf", F.array(*[F.col(c).cast("double") for c in feats]))
        train = df.filter(F.col("split") == "train")
        test = df.filter(F.col("split") == "test")
        coefs = M.fit_linear_grid(train, ("xf", len(feats)), KEYS, "ridge", [{"alpha": alpha}])
        pred = M.predict_linear(test, coefs.drop("param_id", "params"), ("xf", len(feats)))
        return pred.select(*[c for c in PRED if c != "model"], F.lit("").alias("best_params"))
    return build


def _arma():
    def build(split, tune=False, name=""):
        fit = train_valid_union(split)
        test = split.filter(F.col("split") == "test")
        pred = M.arma_regression(fit, test, C.FEATURES)
        return pred.select(*[c for c in PRED if c != "model"], F.lit("").alias("best_params"))
    return build


def tree_models(rows: DataFrame, params: T.TreeParams, keys=tuple(KEYS)) -> DataFrame:
    """Model table of one ensemble per series of ``rows``."""
    keys = list(keys)
    cuts = materialize(T.cut_values(rows.dropna(subset=[*C.FEATURES, "y"]), C.FEATURES, keys), "tree-cuts")
    blocks = materialize(T.binned_blocks(rows, C.FEATURES, keys, cuts), "tree-blocks")
    return materialize(T.fit_trees(blocks, cuts, params, keys), "tree-models")


def tree_grid(name: str, n_iter: int = M.N_ITER) -> list[dict]:
    """Sampled points of a boosted model's published search space, as changes to its preset. A depth of -1 is none: the
    leaves bound the tree; the row share of best-leaf-first boosting has no effect without a bagging frequency."""
    points = [dict(p) for p in M.sample_grid(M.TUNING_GRIDS[name], n_iter)]
    for p in points:
        if p["depth"] < 0:
            p["depth"] = p["leaves"] - 1
        if name == "LightGBM":
            p.pop("rows")
    return points


def tuned_tree_models(rows: DataFrame, preset: str, grid: list[dict], keys=tuple(KEYS)) -> tuple[DataFrame, DataFrame]:
    """(models, best): boosted models refitted on all ``rows`` with the best grid point of each series, and that point.

    The points that some series chose are fitted one after another, each for its own series."""
    best = materialize(T.tune_trees(rows, C.TREE_PRESETS[preset], grid, C.FEATURES, list(keys)), "tree-tuning")
    out = None
    for r in best.select("param_id").distinct().collect():  # at most the grid's points
        own = rows.join(best.filter(F.col("param_id") == r[0]).select(*keys), list(keys), "left_semi")
        models = tree_models(own, T.params_of(preset, **grid[r[0]]), keys)
        out = models if out is None else out.unionByName(models)
    params = F.array(*[F.lit(json.dumps(g)) for g in grid])
    return out, best.withColumn("params", F.element_at(params, F.col("param_id") + 1))


def _tree(preset):
    def build(split, tune=False, name=""):
        """One ensemble per series, all of them grown by the same jobs; tuned on train and validation rows if asked."""
        if tune and preset in M.TUNING_GRIDS:
            models, best = tuned_tree_models(train_valid_union(split), preset, tree_grid(preset))
            pred = T.predict_trees(split.filter(F.col("split") == "test"), models, C.FEATURES, KEYS, ["date", "y"])
            return pred.join(best.select(*KEYS, F.col("params").alias("best_params")), KEYS).select(*[c for c in PRED if c != "model"], "best_params")
        models = tree_models(split.filter(F.col("split") == "train"), T.params_of(preset))
        test = split.filter(F.col("split") == "test")
        pred = T.predict_trees(test, models, C.FEATURES, KEYS, ["date", "y"])
        return pred.select(*[c for c in PRED if c != "model"], F.lit("").alias("best_params"))
    return build


def model_specs(include_trees: bool = True) -> list[ModelSpec]:
    specs = [
        ModelSpec("Ridge", "tabular_linear", 1, _linear("ridge", {"alpha": 1.0}), True),
        ModelSpec("ElasticNet", "tabular_linear", 1, _linear("elastic_net", {"alpha": 0.01, "l1_ratio": 0.2}), True),
        ModelSpec("LinearRegression", "tabular_linear", 1, _linear("ols", {"alpha": 0.0})),
        ModelSpec("WindowRidge_168h", "sequential_window", 2, _window("window"), True),
        ModelSpec("DLinear", "neuralforecast", 4, _window("dlinear")),
        ModelSpec("NLinear", "neuralforecast", 4, _window("nlinear")),
        ModelSpec("FourierRegression", "statistical", 1, _fourier()),
        ModelSpec("SARIMAX", "statistical", 1, _arma()),
    ]
    if include_trees:
        specs += [ModelSpec("RandomForest", "tabular_tree", 2, _tree("RandomForest")),
                  ModelSpec("ExtraTrees", "tabular_tree", 2, _tree("ExtraTrees")),
                  ModelSpec("XGBoost", "tabular_boosting", 2, _tree("XGBoost")),
                  ModelSpec("LightGBM", "tabular_boosting", 2, _tree("LightGBM")),
                  ModelSpec("CatBoost", "tabular_boosting", 2, _tree("CatBoost"))]
    return specs


_RUNTIMES: dict = {}


def fit_predict(split: DataFrame, spec: ModelSpec, tune: bool = False, memo: tuple | None = None) -> tuple[DataFrame, float]:
    """Predictions of one spec for every series, materialized (so runtime is
    the spec's own fit + predict) with its wall time.  ``memo`` names the split:
    a model that this application has fitted to it is not fitted again."""
    tuned = bool(tune and spec.tunable)
    key = (split.sparkSession.sparkContext.applicationId, memo, spec.name, tuned)

    def build():
        return spec.build(split, tuned, spec.name).withColumn("model", F.lit(spec.name))

    t0 = time.perf_counter()
    if memo is None:
        return materialize(build(), f"pred-{spec.name}"), time.perf_counter() - t0
    pred = materialized(split.sparkSession, f"pred-{spec.name}", (memo, tuned), build)
    _RUNTIMES.setdefault(key, time.perf_counter() - t0)
    return pred, _RUNTIMES[key]


def benchmark(split: DataFrame, specs: list[ModelSpec], baselines: DataFrame | None = None, tune: bool = True,
              mode: str = "operational", memo: tuple | None = None) -> tuple[DataFrame, DataFrame]:
    """(metrics with champion flags, long predictions).  A failing spec gives
    an error row and the run continues."""
    from hourcast.operators.select import error_rows
    spark = split.sparkSession
    preds, meta, errors = [], [], []
    for order, spec in enumerate(specs):
        try:
            p, rt = fit_predict(split, spec, tune, memo)
            preds.append(p.select(*PRED, "best_params"))
            meta.append((spec.name, spec.group, spec.complexity_rank, round(rt, 4),
                         bool(tune and spec.tunable), 100 + order))
        except Exception as exc:  # noqa: BLE001 - the benchmark goes on
            errors.append({"station_id": None, "mode": mode, "horizon": None, "model": spec.name,
                           "group": spec.group, "complexity_rank": spec.complexity_rank, "error": str(exc)})
    if not preds:
        raise RuntimeError("every model failed: " + "; ".join(f"{e['model']}: {e['error'][:200]}" for e in errors))
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    bp = allp.groupBy(*KEYS, "model").agg(F.first("best_params").alias("best_params"))
    md = spark.createDataFrame(meta, "model string, group string, complexity_rank int, runtime_seconds double, "
                                     "tuned boolean, spec_order int")
    met = regression_metrics(allp.select(*PRED)).join(F.broadcast(md), "model").join(bp, KEYS + ["model"], "left")
    met = met.select(F.lit(mode).alias("mode"), "*", F.lit("ok").alias("status"), F.lit("").alias("error"))
    if baselines is not None:
        met = met.unionByName(baselines, allowMissingColumns=True)
    if errors:
        met = met.unionByName(error_rows(spark, errors), allowMissingColumns=True)
    return select_champion(met), allp.select(*PRED)

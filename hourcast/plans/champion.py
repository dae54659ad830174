"""Champion export and serving: the deployable champion of every (station, horizon) is fitted on all its rows, written
as a new version of the artifact tables, listed in a manifest, and later loaded by precedence and applied to rows.

A version is a folder with the tables ``linear`` (coefficients) and ``trees`` (node arrays), a row or a few per
series, and the manifest, which is written last: readers take the highest version whose manifest is complete, so
an export that broke off is never read and one that goes on beside them changes nothing for them.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY
from hourcast.operators import models as M
from hourcast.operators import serve as SV
from hourcast.operators import trees as T
from hourcast.operators.select import deployable_champion
from hourcast.operators.series import epoch_hour
from hourcast.plans.models import tree_models
from hourcast.sources import files as FL

KEYS = [KEY, "horizon"]
#: Kind and default parameters of the linear models that can be deployed.
LINEAR = {"Ridge": ("ridge", {"alpha": 1.0}), "ElasticNet": ("elastic_net", {"alpha": 0.01, "l1_ratio": 0.2}), "LinearRegression": ("ols", {"alpha": 0.0})}
MANIFEST = (f"{KEY} string, horizon int, model_name string, artifact_path string, forecast_mode string, uses_future_weather_forecast boolean, "
            "feature_columns array<string>, target string, trained_at string, train_rows long, MAE double, RMSE double, R2 double, "
            "recall_unhealthy_plus double, mae_top5 double, selection_rule string, version int, created_at string")


def champions_to_deploy(selected: DataFrame) -> DataFrame:
    """Metric rows of the deployable champion of every operational (station, horizon): the champion itself, or the best
    deployable model where the champion cannot be deployed. A group without any raises ValueError."""
    picked = deployable_champion(selected)
    without = picked.filter("deployable_model is null").select(*KEYS).limit(5).collect()
    if without:
        raise ValueError(f"no deployable model for {[tuple(r) for r in without]}")
    rows = selected.filter((F.col("status") == "ok") & (F.col("mode") == "operational"))
    return rows.join(picked.select(*KEYS, F.col("deployable_model").alias("model")), [*KEYS, "model"])


def _refit_linear(rows: DataFrame, picked: DataFrame) -> DataFrame | None:
    """Coefficients of the linear champions on all rows of their series, with the tuned parameters where there are any."""
    parts = []
    for name, (kind, default) in LINEAR.items():
        own = picked.filter(F.col("model") == name).select(*KEYS, F.when(F.col("best_params") != "", F.col("best_params")).otherwise(json.dumps(default)).alias("params"))
        grid = M.sample_grid(M.TUNING_GRIDS[name]) if name in M.TUNING_GRIDS else []
        fitted = M.fit_linear_grid(rows.join(own.select(*KEYS), KEYS, "left_semi"), C.FEATURES, KEYS, kind, [*grid, *([] if default in grid else [default])])
        parts.append(fitted.join(own, [*KEYS, "params"]).select(*KEYS, F.lit(name).alias("model"), "params", "intercept", "coef"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Version numbers under ``root`` and whether each has a complete manifest."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n.split("=")[1]) for n in names if n.startswith("version=") and n.split("=")[1].isdigit()]
    return {v: FL.path_exists(spark, f"{root}/version={v}/manifest/_SUCCESS") for v in numbers}


def export_champions(selected: DataFrame, rows: DataFrame, root: str) -> int:
    """Fits, writes and lists the deployable champions; returns the new version.

    ``selected``: metrics with champion flags; ``rows``: all valid rows of every series. Linear models keep their tuned
    parameters; tree ensembles have their published ones."""
    spark = rows.sparkSession
    version = max(versions(spark, root), default=0) + 1
    path = f"{root}/version={version}"
    picked = champions_to_deploy(selected).select(*KEYS, "model", "best_params", "MAE", "RMSE", "R2", "recall_unhealthy_plus", "mae_top5")
    picked.write.parquet(f"{path}/picked")
    picked = spark.read.parquet(f"{path}/picked")
    _refit_linear(rows, picked).write.parquet(f"{path}/linear")
    names = [r["model"] for r in picked.select("model").distinct().collect() if r["model"] in C.TREE_PRESETS]  # at most the presets
    empty = spark.createDataFrame([], f"{KEY} string, horizon int, {T.MODEL}, model string")
    empty.write.parquet(f"{path}/trees")
    for name in names:
        own = rows.join(picked.filter(F.col("model") == name).select(*KEYS), KEYS, "left_semi")
        tree_models(own, T.params_of(name)).withColumn("model", F.lit(name)).write.mode("append").parquet(f"{path}/trees")
    counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("train_rows"))
    entries = FL.manifest_rows(picked.join(counts, KEYS), C.FEATURES, root).withColumn(
        "artifact_path", F.concat(F.lit(f"{path}/"), F.when(F.col("model_name").isin(*LINEAR), "linear").otherwise("trees")))
    FL.write_manifest(entries.withColumn("version", F.lit(version)).withColumn("created_at", F.col("trained_at")), f"{path}/manifest")
    return version


class Champions:
    """The newest complete version under ``root``; ``legacy`` is a coefficient table (keys, intercept, coef) that
    serves series without an entry."""

    def __init__(self, spark: SparkSession, root: str, legacy: DataFrame | None = None):
        complete = [v for v, ok in versions(spark, root).items() if ok]
        self.version = max(complete, default=None)
        self.legacy = legacy
        self.manifest = FL.read_manifest(spark, f"{root}/version={self.version}/manifest", MANIFEST) if complete else None
        self.linear = spark.read.parquet(f"{root}/version={self.version}/linear") if complete else None
        self.trees = spark.read.parquet(f"{root}/version={self.version}/trees") if complete else None

    def predict(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """(keys, keep..., label, source, prediction) of every row: by its champion, else by the legacy table, else
        null with the source ``missing``. ``keep`` must have the row's date, by whose hours rows are dealt."""
        d = rows.select(*KEYS, *keep, *[F.col(c).cast("double").alias(c) for c in C.FEATURES if c not in keep])
        out = d.select(*KEYS, *keep)
        scored = []
        if self.manifest is not None:
            linear = _dot(d, self.linear)
            scored.append(linear.select(*KEYS, *keep, "model", "prediction"))
            names = self.trees.select(*KEYS, "model").distinct()
            trees = T.predict_trees(d.withColumn("_hour", epoch_hour("date")), self.trees.drop("model"), C.FEATURES, KEYS, keep, "prediction", "_hour").join(names, KEYS)
            scored.append(trees.select(*KEYS, *keep, "model", "prediction"))
        found = None
        for s in scored:
            s = s.select(*KEYS, *keep, F.concat(F.lit("Champion: "), "model").alias("label"), F.lit("champion").alias("source"), "prediction")
            found = s if found is None else found.unionByName(s)
        if self.legacy is not None:
            old = _dot(d, self.legacy.withColumn("model", F.lit("legacy")))
            if found is not None:
                old = old.join(found.select(*KEYS).distinct(), KEYS, "left_anti")
            old = old.select(*KEYS, *keep, F.lit("Legacy model").alias("label"), F.lit("legacy").alias("source"), "prediction")
            found = old if found is None else found.unionByName(old)
        if found is None:
            return out.select("*", F.lit("Missing model").alias("label"), F.lit("missing").alias("source"), F.lit(None).cast("double").alias("prediction"))
        missing = out.join(found.select(*KEYS).distinct(), KEYS, "left_anti").select(
            "*", F.lit("Missing model").alias("label"), F.lit("missing").alias("source"), F.lit(None).cast("double").alias("prediction"))
        return found.unionByName(missing)


def _dot(rows: DataFrame, coefs: DataFrame) -> DataFrame:
    return M.predict_linear(rows, coefs.select(*KEYS, "model", "intercept", "coef"), C.FEATURES, "prediction")


def forecast(champions: Champions, features: DataFrame) -> DataFrame:
    """Every horizon's forecast from each station's last row, with its AQI level."""
    rows = SV.forecast_rows(features)
    return SV.with_aqi_level(champions.predict(rows, ["date", "target_time"]))


def nowcast(champions: Champions, features: DataFrame, as_of=None) -> DataFrame:
    """The one-hour forecast from each station's row of the previous full hour (its last row where there is none)."""
    now = F.date_trunc("hour", F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()).cast("timestamp_ntz")
    at = features.groupBy(KEY).agg(F.max("date").alias("_last"), F.max(F.when(F.col("date") == now - F.expr("INTERVAL 1 HOUR"), F.col("date"))).alias("_hour"))
    rows = features.join(at.select(KEY, F.coalesce("_hour", "_last").alias("_at")), KEY).filter(F.col("date") == F.col("_at")).drop("_at")
    rows = rows.withColumn("horizon", F.lit(1)).withColumn("target_time", F.col("date") + F.expr("INTERVAL 1 HOUR"))
    return SV.with_aqi_level(champions.predict(rows, ["date", "target_time"]))


def nowcast_validation(champions: Champions, features: DataFrame) -> DataFrame:
    """MAE of the one-hour champion over each station's last measured hours, each predicted from the measured row before."""
    frame = SV.nowcast_validation_frame(features, C.FEATURES).withColumn("horizon", F.lit(1))
    return SV.nowcast_validation_mae(champions.predict(frame.dropna(subset=C.FEATURES), ["date", "actual"]))


def cards(champions: Champions) -> DataFrame:
    """A Markdown card for each champion, one text column."""
    fields = [("Model", "model_name"), ("Station", KEY), ("Horizon (h)", "horizon"), ("Mode", "forecast_mode"), ("Target", "target"), ("Train rows", "train_rows"),
              ("MAE", "MAE"), ("RMSE", "RMSE"), ("R2", "R2"), ("Recall unhealthy", "recall_unhealthy_plus"), ("MAE top 5 %", "mae_top5"),
              ("Rule", "selection_rule"), ("Version", "version"), ("Artifact", "artifact_path")]
    lines = [F.concat(F.lit("# "), "model_name", F.lit(" t+"), F.col("horizon").cast("string"), F.lit(" "), KEY), F.lit("")]
    lines += [F.concat(F.lit(f"- {title}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for title, c in fields]
    return champions.manifest.select(KEY, "horizon", F.concat_ws("\n", *lines).alias("card"))

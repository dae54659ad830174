"""Benchmark plans: predictions of many models as one long table, metrics in
one aggregation, ranking and champion selection."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.operators import baselines as B
from hourcast.operators.metrics import regression_metrics
from hourcast.operators.prep import chrono_split, oracle_weather_shift, valid_rows, valid_rows_all
from hourcast.operators.select import select_champion


def split_all(features: DataFrame, horizons=None) -> DataFrame:
    """(station, horizon) target series with idx / n / split."""
    return chrono_split(valid_rows_all(features, horizons or C.HORIZONS))


def split_by_mode(features: DataFrame, horizons=None, modes=tuple(C.FORECAST_MODES)) -> DataFrame:
    """(station, mode, horizon) target series with idx / n / split: the mode is part of the series, and in the mode
    ``oracle_weather`` a row has the weather of its target hour."""
    parts = [valid_rows(oracle_weather_shift(features, h, m), h).select(*features.columns, "y", "horizon", F.lit(m).alias("mode"))
             for m in modes for h in horizons or C.HORIZONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return chrono_split(out)


def baseline_predictions(split: DataFrame, horizons=None, only: str | None = None) -> DataFrame:
    return B._predict(split, B.baseline_specs(only), None, horizons=horizons or C.HORIZONS)


def with_model_meta(metrics: DataFrame, mode: str = "operational") -> DataFrame:
    order = F.create_map(*[x for i, m in enumerate(B.BASELINE_ORDER) for x in (F.lit(m), F.lit(i))])
    return metrics.select(
        F.lit(mode).alias("mode"), "*", F.lit("ok").alias("status"), F.lit("").alias("error"),
        F.lit("corrected_baseline").alias("group"), F.lit(0).alias("complexity_rank"),
        F.lit(0.0).alias("runtime_seconds"), F.lit(False).alias("tuned"), F.lit("").alias("best_params"),
        F.coalesce(order[F.col("model")], F.lit(99)).alias("spec_order"))


def baseline_metrics(features: DataFrame, horizons=None, mode: str = "operational") -> DataFrame:
    """Metrics of the baselines on a feature table, or on one that is split already."""
    split = features if "split" in features.columns else split_all(features, horizons)
    preds = baseline_predictions(split, horizons)
    return with_model_meta(regression_metrics(preds), mode)


def baseline_selection(features: DataFrame, horizons=None) -> DataFrame:
    return select_champion(baseline_metrics(features, horizons))

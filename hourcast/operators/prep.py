"""Dataset preparation: forecast modes, valid rows, chronological split,
expanding-window folds and rolling-origin windows.

Row positions are computed without a per-station global sort: a row's index is
(#rows of the station in earlier blocks) + (row number inside its block), the
first term coming from a small per-block count table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY
from hourcast.operators.features import target_col
from hourcast.operators.series import (BLK, POS, block_hours, block_window, core_only, series_keys, with_halo,
                                       with_pos)

IDX = "idx"
N = "n"


def oracle_weather_shift(features: DataFrame, horizon: int, mode: str = "operational",
                         block: int | None = None) -> DataFrame:
    """``oracle_weather``: weather at t+h replaces weather at t (before masking);
    ``operational``: unchanged; any other mode is an error."""
    if mode not in C.FORECAST_MODES:
        raise ValueError(f"forecast_mode must be one of {sorted(C.FORECAST_MODES)}, got {mode!r}")
    if mode == "operational":
        return features
    block = block_hours(features, block)
    hx = with_halo(with_pos(features, "date"), 0, horizon, block)
    w = block_window(series_keys(hx))
    cols = [F.lead(c, horizon).over(w).alias(c) if c in C.WEATHER_COLUMNS else F.col(c) for c in hx.columns]
    return core_only(hx.select(*cols))


def valid_rows(features: DataFrame, horizon: int, feature_cols=None) -> DataFrame:
    """Rows with a target for ``horizon`` and every model feature present; adds ``y``."""
    feature_cols = feature_cols or C.FEATURES
    t = target_col(horizon)
    return (features.dropna(subset=[t] + list(feature_cols))
                    .withColumn("y", F.col(t)).withColumn("horizon", F.lit(horizon)))


def series_index(df: DataFrame, block: int | None = None, order: str = POS) -> DataFrame:
    """0-based row index per station (``idx``) and station row count (``n``)."""
    block = block_hours(df, block)
    df = with_pos(df, "date" if "date" in df.columns else C.TIME)
    keys = series_keys(df)
    b = df.withColumn(BLK, F.floor(F.col(order) / block).cast("long"))
    counts = b.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy(*keys).orderBy(BLK)
    offs = counts.select(*keys, BLK,
                         F.coalesce(F.sum("_bn").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_off"),
                         F.sum("_bn").over(Window.partitionBy(*keys)).alias(N))
    rn = F.row_number().over(Window.partitionBy(*keys, BLK).orderBy(order)) - 1
    return (b.withColumn("_rn", rn).join(offs, [*keys, BLK])
             .withColumn(IDX, (F.col("_off") + F.col("_rn")).cast("long")).drop("_rn", "_off", BLK))


def split_bounds(n):
    """(train_end, valid_end) with the published double arithmetic:
    floor(n*0.7) and floor(n*(0.7+0.1)) where 0.7+0.1 = 0.7999999999999999."""
    train_end = F.floor(n * F.lit(C.TRAIN_RATIO))
    valid_end = F.floor(n * (F.lit(C.TRAIN_RATIO) + F.lit(C.VALID_RATIO)))
    return train_end, valid_end


def chrono_split(valid: DataFrame, block: int | None = None) -> DataFrame:
    """70/10/20 by row position per station: adds idx, n, split."""
    df = series_index(valid, block)
    te, ve = split_bounds(F.col(N))
    return df.withColumn("split", F.when(F.col(IDX) < te, "train").when(F.col(IDX) < ve, "valid").otherwise("test"))


def train_valid_union(split: DataFrame, include_test: bool = False) -> DataFrame:
    keep = ["train", "valid"] + (["test"] if include_test else [])
    return split.filter(F.col("split").isin(*keep))


def time_series_folds(df: DataFrame, k: int = C.CV_N_SPLITS, block: int | None = None) -> DataFrame:
    """Expanding-window folds (TimeSeriesSplit): test size n div (k+1); fold i
    (1..k) tests on block i and trains on every earlier row.  One output row per
    (row, fold) in which the row takes part, with ``role`` train/test."""
    d = series_index(df, block) if IDX not in df.columns else df
    ts = F.floor(F.col(N) / (k + 1))
    first_test = F.col(N) - ts * k
    folds = F.sequence(F.lit(1), F.lit(k))
    out = d.withColumn("fold", F.explode(folds))
    start = first_test + (F.col("fold") - 1) * ts
    out = out.withColumn("role", F.when(F.col(IDX) < start, "train")
                         .when(F.col(IDX) < start + ts, "test"))
    return out.filter(F.col("role").isNotNull() & (ts > 0))


def rolling_origin_windows(series: DataFrame, horizons=None, n_max: int = 6, quick: bool = False,
                           block: int | None = None) -> DataFrame:
    """Backtest windows: holdout = n - floor(0.8 n); n_windows = min(6, max(1, holdout div H))
    (2 when quick), windows of H rows stepping H over the tail; each tail row gets
    its window, cutoff index and forecast horizon; rows whose horizon is not
    listed are dropped."""
    horizons = horizons or C.HORIZONS
    H = max(horizons)
    d = series_index(series, block) if IDX not in series.columns else series
    holdout = F.col(N) - F.floor(F.col(N) * F.lit(0.8))
    nw = F.lit(2) if quick else F.least(F.lit(n_max), F.greatest(F.lit(1), F.floor(holdout / H)))
    test_start = F.col(N) - nw * H
    w = F.floor((F.col(IDX) - test_start) / H)
    out = (d.withColumn("window", w.cast("int"))
            .withColumn("cutoff_idx", (test_start + F.col("window") * H - 1).cast("long"))
            .withColumn("forecast_horizon", (F.col(IDX) - F.col("cutoff_idx")).cast("int")))
    return out.filter((F.col(IDX) >= test_start) & (holdout >= H) & F.col("forecast_horizon").isin(*horizons))


def valid_rows_all(features: DataFrame, horizons=None, feature_cols=None) -> DataFrame:
    """All horizons at once: one target series per (station, horizon) with
    column ``y``; rows lacking the target or any model feature are dropped."""
    horizons = horizons or C.HORIZONS
    feature_cols = feature_cols or C.FEATURES
    tgt = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(target_col(h)).alias("y"))
                              for h in horizons])).alias("_h")
    out = features.select("*", tgt).select("*", "_h.horizon", "_h.y").drop("_h")
    return out.dropna(subset=["y"] + list(feature_cols))

"""Leak-free baselines over the target series of a split frame.

The target series is already shifted by h (y(t) = value at t+h), so a lag of h
rows is the value observed at the forecast origin.  Predictions are produced for
test rows; a missing history falls back to the station's train mean.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY
from hourcast.operators.prep import IDX
from hourcast.operators.series import POS, block_hours, block_window, core_only, series_keys, with_halo

PRED_COLS = [KEY, "horizon", "model", "date", "y", "yhat"]


def _train_mean(split: DataFrame) -> DataFrame:
    return split.groupBy(*series_keys(split)).agg(F.avg(F.when(F.col("split") == "train", F.col("y"))).alias("_train_mean"))


def _predict(split: DataFrame, specs: list, block: int | None, keep=("train", "valid", "test"),
             horizons=None) -> DataFrame:
    """One halo'd window pass for every (model, horizon).

    specs: (model name, builder(y, w, h) -> Column | None, history(h) -> rows).
    A builder returning None means the model does not apply at that horizon.
    """
    block = block_hours(split, block)
    horizons = horizons or C.HORIZONS
    src = split.filter(F.col("split").isin(*keep))
    back = max(hist(h) for _n, fn, hist in specs for h in horizons if fn(F.col("y"), None, h) is not None)
    hx = with_halo(src, back, 0, block)
    keys = series_keys(hx)
    w = block_window(keys)
    y = F.col("y")
    pcols, structs = [], []
    for i, (name, fn, _hist) in enumerate(specs):
        expr, ok = None, []
        for h in horizons:
            c = fn(y, w, h)
            if c is None:
                continue
            ok.append(h)
            expr = (F.when(F.col("horizon") == h, c) if expr is None else expr.when(F.col("horizon") == h, c))
        if expr is None:
            continue
        pcols.append(expr.alias(f"_p{i}"))
        structs.append(F.when(F.col("horizon").isin(*ok),
                              F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("p"))))
    wins = hx.select(*keys, "date", "split", "y", "_core", "_blk", *pcols)
    preds = F.filter(F.array(*structs), lambda s: s.isNotNull())
    out = core_only(wins.filter(F.col("split") == "test")
                        .select(*keys, "date", "split", "y", "_core", "_blk", F.explode(preds).alias("_m")))
    out = out.join(_train_mean(split), keys, "left")
    return out.select(*keys, F.col("_m.model").alias("model"), "date", "y",
                      F.coalesce(F.col("_m.p"), F.col("_train_mean")).alias("yhat"))


def shifted_spec(name: str, period: int | None = None):
    """Shift of the target series by ``period`` rows (by h when None); invalid
    (None) when the period is shorter than the horizon."""
    def fn(y, w, h):
        p = h if period is None else period
        if p < h:
            return None
        return F.lag(y, p).over(w) if w is not None else F.lit(p)
    return (name, fn, lambda h: h if period is None else period)


def rolling_spec(name: str, window: int):
    """Mean of the last ``window`` values observable at the origin (min 1)."""
    def fn(y, w, h):
        return F.avg(y).over(w.rowsBetween(-(h + window - 1), -h)) if w is not None else F.lit(window)
    return (name, fn, lambda h: h + window - 1)


BASELINE_SPECS = [shifted_spec("Persistence"), rolling_spec("RollingMean_24h", 24),
                  rolling_spec("RollingMean_168h", 168), shifted_spec("SeasonalNaive_168h", 168),
                  shifted_spec("SeasonalNaive_24h", 24)]
BASELINE_ORDER = [s[0] for s in BASELINE_SPECS]


def baseline_specs(only: str | None = None):
    return [s for s in BASELINE_SPECS if only is None or s[0] == only]


def persistence(split: DataFrame, horizons=None, block: int | None = None) -> DataFrame:
    return _predict(split, baseline_specs("Persistence"), block, horizons=horizons)


def seasonal_naive(split: DataFrame, period: int, horizons=None, block: int | None = None) -> DataFrame:
    """Shift by the season; rows of horizons longer than the period are not produced."""
    return _predict(split, [shifted_spec(f"SeasonalNaive_{period}h", period)], block, horizons=horizons)


def rolling_mean_baseline(split: DataFrame, window: int, horizons=None, block: int | None = None) -> DataFrame:
    return _predict(split, [rolling_spec(f"RollingMean_{window}h", window)], block, horizons=horizons)


def all_baselines(split: DataFrame, horizons=None, block: int | None = None) -> DataFrame:
    """Every baseline at every horizon in a single halo'd window pass."""
    return _predict(split, BASELINE_SPECS, block, horizons=horizons)


def _legacy(split: DataFrame, period: int | None, name: str, block: int | None, horizons=None) -> DataFrame:
    """Older variants over train+test only: the valid block is cut out and
    positions are re-numbered, so the shift crosses a false gap."""
    n_valid = F.sum(F.when(F.col("split") == "valid", 1).otherwise(0))
    keys = series_keys(split)
    nv = split.groupBy(*keys).agg(n_valid.alias("_nv"))
    src = (split.filter(F.col("split").isin("train", "test")).join(nv, keys)
                .withColumn(POS, F.when(F.col("split") == "test", F.col(IDX) - F.col("_nv"))
                            .otherwise(F.col(IDX))).drop("_nv"))
    return _predict(src, [shifted_spec(name, period)], block, keep=("train", "test"), horizons=horizons)


def naive_legacy(split: DataFrame, horizons=None, block: int | None = None) -> DataFrame:
    """Legacy persistence: shift by h over train+test only."""
    return _legacy(split, None, "NaivePersistence", block, horizons)


def seasonal_naive_legacy(split: DataFrame, period: int = 168, horizons=None,
                          block: int | None = None) -> DataFrame:
    """Legacy seasonal naive over train+test only (horizons above the period are invalid)."""
    return _legacy(split, period, f"SeasonalNaive({period}h)", block, horizons)

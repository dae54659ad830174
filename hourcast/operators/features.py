"""Feature engineering: calendar, cyclical, lag, rolling, trend, ratio and
direct multi-horizon targets.  All windows share one partition/order spec over
(station, block) with a halo, so the plan has a single Exchange + Sort feeding
one Window node."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY, TARGET, TIME
from hourcast.operators.series import (POS, block_hours, block_window, core_only, series_keys, with_halo,
                                       with_pos)

FEATURE_HALO_BACK = max(C.LAGS + [m + 1 for m in C.ROLL_MEANS] + C.DIFFS)
FEATURE_HALO_FWD = max(C.HORIZONS)


def target_col(h: int) -> str:
    return f"target_{TARGET}_t{h}"


def calendar_features(df: DataFrame, time_col: str = TIME) -> DataFrame:
    t = F.col(time_col)
    return df.select("*", F.hour(t).alias("hour"), F.weekday(t).alias("day_of_week"), F.month(t).alias("month"),
                     F.dayofyear(t).alias("day_of_year"), F.year(t).alias("year"))


def season_flags(df: DataFrame) -> DataFrame:
    return df.select("*",
                     (F.col("day_of_week") >= 5).cast("int").alias("is_weekend"),
                     F.col("month").isin(*C.WINTER_MONTHS).cast("int").alias("is_winter"),
                     F.col("month").isin(*C.SUMMER_MONTHS).cast("int").alias("is_summer"),
                     F.ceil(F.col("month") / 3).cast("int").alias("season"))


def cyclical_features(df: DataFrame) -> DataFrame:
    two_pi = F.lit(2 * math.pi)
    cols = []
    for name, src, period in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12)):
        arg = two_pi * F.col(src) / F.lit(period)
        cols += [F.sin(arg).alias(f"{name}_sin"), F.cos(arg).alias(f"{name}_cos")]
    return df.select("*", *cols)


def _lag_cols(y, w):
    return [F.lag(y, k).over(w).alias(f"{TARGET}_lag_{k}") for k in C.LAGS]


def _rolling_cols(y, w):
    out = []

    def full(n, agg):
        fr = w.rowsBetween(-n, -1)
        return F.when(F.count(y).over(fr) == n, agg.over(fr))

    for n in C.ROLL_MEANS:
        out.append(full(n, F.avg(y)).alias(f"{TARGET}_roll{n}_mean"))
    out.append(full(C.ROLL_STD, F.stddev_samp(y)).alias(f"{TARGET}_roll{C.ROLL_STD}_std"))
    out.append(full(C.ROLL_MAX, F.max(y)).alias(f"{TARGET}_roll{C.ROLL_MAX}_max"))
    return out


def _trend_cols(y, w):
    names = {1: "1h", 24: "24h"}
    return [(y - F.lag(y, k).over(w)).alias(f"{TARGET}_diff_{names.get(k, f'{k}h')}") for k in C.DIFFS]


def _target_cols(y, w, horizons):
    return [F.lead(y, h).over(w).alias(target_col(h)) for h in horizons]


def _windowed(df: DataFrame, builders, back: int, fwd: int, block: int | None) -> DataFrame:
    block = block_hours(df, block)
    hx = with_halo(with_pos(df), back, fwd, block)
    w = block_window(series_keys(hx))
    cols = [c for b in builders for c in b(w)]
    return core_only(hx.select("*", *cols))


def lag_features(df: DataFrame, block: int | None = None) -> DataFrame:
    y = F.col(TARGET)
    return _windowed(df, [lambda w: _lag_cols(y, w)], max(C.LAGS), 0, block)


def rolling_features(df: DataFrame, block: int | None = None) -> DataFrame:
    y = F.col(TARGET)
    return _windowed(df, [lambda w: _rolling_cols(y, w)], max(C.ROLL_MEANS) + 1, 0, block)


def trend_features(df: DataFrame, block: int | None = None) -> DataFrame:
    y = F.col(TARGET)
    return _windowed(df, [lambda w: _trend_cols(y, w)], max(C.DIFFS), 0, block)


def ratio_features(df: DataFrame) -> DataFrame:
    if "pm10" not in df.columns:
        return df
    return df.withColumn("pm25_pm10_ratio", F.col(TARGET) / (F.col("pm10") + F.lit(C.RATIO_EPS)))


def horizon_targets(df: DataFrame, horizons=None, block: int | None = None) -> DataFrame:
    horizons = horizons or C.HORIZONS
    y = F.col(TARGET)
    return _windowed(df, [lambda w: _target_cols(y, w, horizons)], 0, max(horizons), block)


def target_coverage(features: DataFrame, horizons=None) -> DataFrame:
    """Non-null target count per station and horizon."""
    horizons = horizons or C.HORIZONS
    agg = features.groupBy(KEY).agg(*[F.count(target_col(h)).alias(f"h{h}") for h in horizons])
    stack = ", ".join(f"{h}, h{h}" for h in horizons)
    return agg.selectExpr(KEY, f"stack({len(horizons)}, {stack}) as (horizon, n_valid)")


def feature_columns(df: DataFrame, horizons=None) -> list[str]:
    horizons = horizons or C.HORIZONS
    skip = {KEY, TIME, "date", POS} | {target_col(h) for h in horizons}
    return [c for c in df.columns if c not in skip and not c.startswith("_")]


def drop_incomplete_inference(df: DataFrame, horizons=None) -> DataFrame:
    return df.dropna(subset=feature_columns(df, horizons))


def drop_incomplete_training(df: DataFrame, horizons=None) -> DataFrame:
    horizons = horizons or C.HORIZONS
    return df.dropna(subset=feature_columns(df, horizons) + [target_col(min(horizons))])


def build_features(clean: DataFrame, horizons=None, is_inference: bool = True,
                   block: int | None = None) -> DataFrame:
    """Composed feature/target table (F6): one halo'd block layout, one sort,
    every lag/rolling/lead column in a single Window pass."""
    horizons = horizons or C.HORIZONS
    y = F.col(TARGET)
    df = cyclical_features(season_flags(calendar_features(with_pos(clean))))
    df = _windowed(df, [lambda w: _lag_cols(y, w), lambda w: _rolling_cols(y, w),
                        lambda w: _trend_cols(y, w), lambda w: _target_cols(y, w, horizons)],
                   FEATURE_HALO_BACK, max(horizons), block)
    df = ratio_features(df)
    df = drop_incomplete_inference(df, horizons) if is_inference else drop_incomplete_training(df, horizons)
    return df.withColumnRenamed(TIME, "date")


F6_ORDER = (["date"] + C.MEASURES + [f"{c}_missing_flag" for c in C.MEASURES]
            + ["hour", "day_of_week", "month", "day_of_year", "year", "is_weekend", "is_winter", "is_summer",
               "season", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
            + [f"{TARGET}_lag_{k}" for k in C.LAGS]
            + [f"{TARGET}_roll{n}_mean" for n in C.ROLL_MEANS]
            + [f"{TARGET}_roll{C.ROLL_STD}_std", f"{TARGET}_roll{C.ROLL_MAX}_max",
               f"{TARGET}_diff_1h", f"{TARGET}_diff_24h", "pm25_pm10_ratio"]
            + [target_col(h) for h in C.HORIZONS])


def feature_table(clean: DataFrame, horizons=None, is_inference: bool = True, block: int | None = None) -> DataFrame:
    """``build_features`` projected to the published 50-column order (+ station_id, _pos)."""
    f = build_features(clean, horizons, is_inference, block)
    return f.select(KEY, *[c for c in F6_ORDER if c in f.columns], POS)


def window_matrix(valid: DataFrame, lookback: int = C.WINDOW_LAGS, block: int | None = None) -> DataFrame:
    """168 consecutive lags (1..lookback, no lag 0) of the target as one array,
    over the already masked rows; incomplete windows dropped."""
    block = block_hours(valid, block)
    hx = with_halo(with_pos(valid), lookback, 0, block)
    fr = block_window(series_keys(hx)).rowsBetween(-lookback, -1)
    out = core_only(hx.select("*", F.collect_list(F.col(TARGET)).over(fr).alias("_hist")))
    # collect_list is oldest-first; lag k is element size-k+1
    out = out.filter(F.size("_hist") == lookback)
    return out.withColumn("window", F.reverse(F.col("_hist"))).drop("_hist")


def latest_feature_row(features: DataFrame, feature_cols: list[str], history_col: str = TARGET,
                       seq_lags: int = C.WINDOW_LAGS) -> DataFrame:
    """Last row per station as model input; ``pm2_5_seq_lag_k`` columns are the
    k-th value from the end of the station's history (k = 1..seq_lags).  A
    station whose history is shorter than a lag is an error."""
    missing = [c for c in feature_cols if c not in features.columns and not c.startswith(f"{TARGET}_seq_lag_")]
    if missing:
        raise KeyError(f"missing feature columns: {missing}")
    df = with_pos(features, "date" if "date" in features.columns else TIME)
    last = df.groupBy(KEY).agg(F.max(POS).alias("_last"))
    tail = (df.join(last, KEY).filter(F.col(POS) > F.col("_last") - seq_lags))
    seq = [c for c in feature_cols if c.startswith(f"{TARGET}_seq_lag_")]
    hist = None
    if seq:
        # k-th from the end: position last - k + 1 (contiguous grid)
        def kth(c):
            k = int(c.rsplit("_", 1)[1])
            short = F.raise_error(F.concat(F.lit(f"not enough history to build {c} of station "), F.first(KEY))).cast("double")
            value = F.max(F.when(F.col(POS) == F.col("_last") - (k - 1), F.col(history_col)))
            return F.when(F.count(F.lit(1)) < k, short).otherwise(value).alias(c)

        hist = tail.groupBy(KEY).agg(*[kth(c) for c in seq])
    row = tail.filter(F.col(POS) == F.col("_last")).select(
        KEY, "date" if "date" in df.columns else TIME, *[c for c in feature_cols if c not in seq])
    return row.join(hist, KEY, "left") if hist is not None else row


def inject_future_weather(rows: DataFrame, forecast: DataFrame, horizon_col: str = "horizon",
                          allowed: bool = True, time_col: str = "date") -> DataFrame:
    """Overwrite the 5 weather columns with the forecast at ``time + horizon``
    when the model allows it; keep current values where no forecast exists."""
    if not allowed:
        return rows
    fc = forecast.select(F.col(TIME).alias("_target_time"),
                         *[F.col(c).alias(f"_fc_{c}") for c in C.WEATHER_COLUMNS])
    tt = F.col(time_col) + F.make_dt_interval(hours=F.col(horizon_col)) if horizon_col in rows.columns \
        else F.col(time_col)
    out = rows.withColumn("_target_time", tt).join(fc, "_target_time", "left")
    for c in C.WEATHER_COLUMNS:
        out = out.withColumn(c, F.coalesce(F.col(f"_fc_{c}"), F.col(c))).drop(f"_fc_{c}")
    return out.drop("_target_time")

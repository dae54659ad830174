"""Exploratory analysis: the data behind each published chart, per station."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY, TARGET, TIME
from hourcast.operators.serve import tail_rows
from hourcast.operators.series import (BLK, POS, exact_quantiles, block_hours, block_window, core_only, series_keys,
                                       value_counts, with_halo, with_pos)


def daily_spine(series: DataFrame, value: str = TARGET) -> DataFrame:
    """Daily mean on a gap-free daily spine per station (empty days NULL)."""
    d = series.select(KEY, F.to_date(TIME).alias("day"), F.col(value).alias("_v"))
    daily = d.groupBy(KEY, "day").agg(F.avg("_v").alias("daily_mean"))
    bounds = daily.groupBy(KEY).agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    days = bounds.select(KEY, F.explode(F.sequence("_lo", "_hi")).alias("day"))
    return days.join(daily, [KEY, "day"], "left")


def daily_trend(series: DataFrame, value: str = TARGET) -> DataFrame:
    """Daily mean with 7- and 30-day rolling means that need full windows.
    Windows run over the daily table (one row per station-day)."""
    d = daily_spine(series, value).withColumn(POS, F.datediff("day", F.lit("1970-01-01")).cast("long"))
    hx = with_halo(d, 29, 0, block_hours(d))
    w = block_window(series_keys(hx))

    def full(n):
        fr = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count("daily_mean").over(fr) == n, F.avg("daily_mean").over(fr))

    out = core_only(hx.select("*", full(7).alias("trend_7d"), full(30).alias("trend_30d")))
    return out.drop(POS)


def with_thresholds(trend: DataFrame, thresholds=tuple(C.EDA_THRESHOLDS)) -> DataFrame:
    """Adds the threshold lines of the daily chart and whether a day's mean lies above each (NULL on days without)."""
    cols = [F.lit(float(t)).alias(f"threshold_{i}") for i, t in enumerate(thresholds)]
    return trend.select("*", *cols, *[(F.col("daily_mean") > F.lit(float(t))).alias(f"above_{i}") for i, t in enumerate(thresholds)])


def seasonal_decompose(clean: DataFrame, value: str = TARGET, period: int = C.DECOMPOSE_PERIOD) -> DataFrame:
    """Classical additive decomposition: centred 2x``period`` moving average
    trend, phase means of the detrended series (centred), residual."""
    half = period // 2
    hx = with_halo(with_pos(clean), half, half, block_hours(clean))
    w = block_window(series_keys(hx))
    y = F.col(value)
    inner = F.sum(y).over(w.rowsBetween(-(half - 1), half - 1))
    ends = 0.5 * (F.lag(y, half).over(w) + F.lead(y, half).over(w))
    cnt = F.count(y).over(w.rowsBetween(-half, half))
    trend = F.when(cnt == 2 * half + 1, (inner + ends) / F.lit(float(period)))
    d = core_only(hx.select(KEY, TIME, POS, y.alias("observed"), trend.alias("trend")))
    d = d.withColumn("phase", (F.col(POS) % period).cast("int"))
    ph = (d.groupBy(KEY, "phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("_pm")))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(KEY)))
    out = d.join(ph.select(KEY, "phase", "seasonal"), [KEY, "phase"], "left")
    return out.withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal")).drop(POS)


def box_stats(df: DataFrame, by: str, value: str = TARGET) -> DataFrame:
    """Box plot statistics per station and ``by``: quartiles (linear), 1.5 IQR
    whiskers clipped to the data, outlier count."""
    keys = [KEY, by]
    n = df.groupBy(*keys).agg(F.count(value).alias("n"))
    q = exact_quantiles(df, value, keys, [0.25, 0.5, 0.75], name="_q").join(n, keys)
    q = q.select(*keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    j = df.select(*keys, F.col(value).alias("_v")).join(q.select(*keys, "q1", "q3"), keys)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    wk = j.groupBy(*keys).agg(F.min(F.when(F.col("_v") >= lo, F.col("_v"))).alias("whisker_lo"),
                              F.max(F.when(F.col("_v") <= hi, F.col("_v"))).alias("whisker_hi"),
                              F.count_if((F.col("_v") < lo) | (F.col("_v") > hi)).alias("n_outliers"))
    return q.join(wk, keys)


def box_by_month(clean: DataFrame, value: str = TARGET) -> DataFrame:
    return box_stats(clean.withColumn("month", F.month(TIME)), "month", value)


def box_by_hour(clean: DataFrame, value: str = TARGET) -> DataFrame:
    return box_stats(clean.withColumn("hour", F.hour(TIME)), "hour", value)


def hour_dow_pivot(clean: DataFrame, value: str = TARGET) -> DataFrame:
    """Mean by hour x weekday (Mon=0), one column per weekday."""
    d = clean.select(KEY, F.hour(TIME).alias("hour"), F.weekday(TIME).alias("dow"), F.col(value).alias("_v"))
    p = d.groupBy(KEY, "hour").pivot("dow", list(range(7))).agg(F.avg("_v"))
    return p.select(KEY, "hour", *[F.col(str(i)).alias(f"dow_{i}") for i in range(7)])


def acf(clean: DataFrame, value: str = TARGET, max_lag: int = C.ACF_MAX_LAG) -> DataFrame:
    """Autocorrelation, lags 0..max_lag, biased denominator:
    sum_t (x_t - m)(x_{t-k} - m) / sum_t (x_t - m)^2 — one halo'd window pass and
    one aggregation per station."""
    df = with_pos(clean)
    m = df.groupBy(KEY).agg(F.avg(value).alias("_m"))
    d = df.join(m, KEY).withColumn("_d", F.col(value) - F.col("_m")).select(KEY, TIME, POS, "_d")
    hx = with_halo(d, max_lag, 0, block_hours(d))
    w = block_window([KEY])
    prods = [(F.col("_d") * F.lag("_d", k).over(w)).alias(f"_p{k}") for k in range(1, max_lag + 1)]
    core = core_only(hx.select(KEY, "_core", BLK, "_d", *prods))
    agg = core.groupBy(KEY).agg(F.sum(F.col("_d") * F.col("_d")).alias("_p0"),
                                *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, max_lag + 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"_p{k}") / F.col("_p0")).alias("acf"))
                     for k in range(max_lag + 1)])
    return agg.select(KEY, F.inline(rows))


def pacf(acf_df: DataFrame, max_lag: int = C.ACF_MAX_LAG) -> DataFrame:
    """Partial autocorrelation by Durbin-Levinson recursion on each station's
    73-row ACF (Yule-Walker, no adjustment); the heavy part is ``acf``."""
    import numpy as np
    import pandas as pd

    def per_station(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy(dtype=float)
        n = len(r) - 1
        out = np.zeros(n + 1)
        out[0] = 1.0
        phi = np.zeros(n + 1)
        prev = np.zeros(n + 1)
        v = r[0]
        for k in range(1, n + 1):
            a = (r[k] - np.dot(prev[1:k], r[1:k][::-1])) / v
            phi[1:k] = prev[1:k] - a * prev[1:k][::-1]
            phi[k] = a
            v = v * (1 - a * a)
            out[k] = a
            prev = phi.copy()
        return pd.DataFrame({KEY: pdf[KEY].iloc[0], "lag": np.arange(n + 1, dtype="int32"), "pacf": out})

    return acf_df.groupBy(KEY).applyInPandas(per_station, f"{KEY} string, lag int, pacf double")


def value_rank(df: DataFrame, col: str, keys=None, bins: int = 64) -> DataFrame:
    """Average rank (ties share the mean rank, 1-based) of ``col`` within each
    key group: rank every distinct value once, from the counts of distinct
    values, and join the ranks back to the rows."""
    keys = list(keys or [KEY])
    vc = value_counts(df, col, keys, bins)
    rank = (F.col("_before") + (F.col("_cnt") + 1) / 2.0).cast("double")
    return df.join(vc.select(*keys, F.col("_v").alias(col), rank.alias(f"{col}_rank")), [*keys, col])


SPEARMAN_COLUMNS = ["pm2_5", "pm10", "co", "no2", "so2", "ozone", "temperature_2m", "relative_humidity_2m",
                    "wind_speed_10m", "pressure_msl"]


def _corr(a: str, b: str):
    """Correlation, NaN where a column is constant: the built-in ``corr`` divides by zero there."""
    sxx, syy = F.regr_sxx(a, b), F.regr_syy(a, b)
    flat = (F.regr_count(a, b) > 1) & ((sxx == 0) | (syy == 0))
    return F.when(flat, F.lit(float("nan"))).otherwise(F.try_divide(F.regr_sxy(a, b), F.sqrt(sxx * syy)))


def spearman_matrix(clean: DataFrame) -> DataFrame:
    """Spearman correlation of the available pollutant/weather columns, lower
    triangle incl. diagonal, long form (col_a, col_b, rho).  Rows must be
    complete (the clean panel has no NULLs); a constant column correlates with
    nothing (NaN).  All columns are ranked in one long-form pass keyed by
    (station, column), then re-aligned by position."""
    cols = [c for c in SPEARMAN_COLUMNS if c in clean.columns]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = with_pos(clean).selectExpr(KEY, POS, f"stack({len(cols)}, {stack}) AS (col, v)")
    ranked = value_rank(long, "v", keys=[KEY, "col"])
    wide = ranked.groupBy(KEY, POS).pivot("col", cols).agg(F.first("v_rank"))
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if j <= i]
    agg = wide.groupBy(KEY).agg(*[_corr(a, b).alias(f"_c{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_c{k}").alias("rho"))
                     for k, (a, b) in enumerate(pairs)])
    return agg.select(KEY, F.inline(rows))


def missing_by_month(clean: DataFrame, cols=("pm2_5", "pm10", "co", "no2", "so2", "ozone", "temperature_2m")) -> DataFrame:
    """Monthly mean of the missing flags x 100 (NULL share when no flags)."""
    flags = [c for c in cols if f"{c}_missing_flag" in clean.columns]
    if flags:
        aggs = [(F.avg(f"{c}_missing_flag") * 100).alias(c) for c in flags]
    else:
        flags = [c for c in cols if c in clean.columns]
        aggs = [(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in flags]
    return clean.groupBy(KEY, F.date_format(TIME, "yyyy-MM").alias("month")).agg(*aggs)


def pred_vs_actual_tail(preds: DataFrame, n: int = C.TAIL_ROWS, keys=(KEY, "horizon", "model")) -> DataFrame:
    """Last ``n`` (actual, predicted) rows of each test series, whatever gaps it has."""
    return tail_rows(preds, n, keys=keys).drop(POS)

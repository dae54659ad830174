"""Backtest scenarios K1-K5 over a long prediction table
(station_id, horizon, model, date, y, yhat)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY
from hourcast.functions.aqi import is_unhealthy_level, pm25_level
from hourcast.operators.metrics import f1_macro
from hourcast.operators.series import exact_quantiles

KEYS = [KEY, "model"]


def _clean(preds):
    return preds.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull())


def backtest_k1_k3(preds: DataFrame, horizons=C.BACKTEST_HORIZONS) -> DataFrame:
    """K1/K2/K3 = h 1/24/72: MAE, RMSE and macro-F1 of AQI levels."""
    p = _clean(preds.filter(F.col("horizon").isin(*horizons)))
    keys = KEYS + ["horizon"]
    e = F.col("yhat") - F.col("y")
    reg = p.groupBy(*keys).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
    scen = F.when(F.col("horizon") == 1, "K1").when(F.col("horizon") == 24, "K2").otherwise("K3")
    return reg.join(f1_macro(p, keys), keys).withColumn("scenario", scen)


def backtest_k4(preds: DataFrame, horizon: int = 24) -> DataFrame:
    """High-pollution episodes: truth >= p95 of all truth rows (taken before
    dropping NULL predictions); MAE, RMSE, unhealthy recall on those rows."""
    p = preds.filter((F.col("horizon") == horizon) & F.col("y").isNotNull())
    thr = exact_quantiles(p, "y", KEYS, [0.95]).select(*KEYS, F.col("q")[0].alias("threshold_95"))
    d = _clean(p).join(thr, KEYS).filter(F.col("y") >= F.col("threshold_95"))
    e = F.col("yhat") - F.col("y")
    tu = is_unhealthy_level(pm25_level("y"))
    pu = is_unhealthy_level(pm25_level("yhat"))
    agg = d.groupBy(*KEYS).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                               F.count_if(tu).alias("_n"), F.count_if(tu & pu).alias("_k"))
    agg = agg.withColumn("recall_unhealthy", F.when(F.col("_n") > 0, F.col("_k") / F.col("_n")).otherwise(0.0))
    return thr.join(agg.drop("_n", "_k"), KEYS, "left")


def backtest_k5(preds: DataFrame, horizon: int = 24) -> DataFrame:
    """Winter (Dec-Feb) vs summer (Jun-Aug) MAE and counts; NULL MAE when empty."""
    d = _clean(preds.filter(F.col("horizon") == horizon)).withColumn("_m", F.month("date"))
    ae = F.abs(F.col("yhat") - F.col("y"))
    win, summ = F.col("_m").isin(*C.K5_WINTER), F.col("_m").isin(*C.K5_SUMMER)
    return d.groupBy(*KEYS).agg(F.avg(F.when(win, ae)).alias("mae_winter"),
                                F.avg(F.when(summ, ae)).alias("mae_summer"),
                                F.count_if(win).alias("count_winter"), F.count_if(summ).alias("count_summer"))


def backtest_by_season(preds: DataFrame, horizon: int = 24) -> DataFrame:
    """The four-season variant (DJF/MAM/JJA/SON) of K5."""
    m = F.month("date")
    season = F.lit(None).cast("string")
    for name, months in C.SEASONS.items():
        season = F.when(m.isin(*months), F.lit(name)).otherwise(season)
    d = _clean(preds.filter(F.col("horizon") == horizon)).withColumn("season", season)
    return d.groupBy(*KEYS, "season").agg(F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae"),
                                          F.count(F.lit(1)).alias("n"))

"""Serving queries over the feature table: latest reading, lag, AQI deltas,
forecasts of every station at once, nowcast validation."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY, TARGET
from hourcast.functions.aqi import aqi_color, aqi_label, pm25_to_aqi
from hourcast.operators.series import BLK, POS, block_hours, with_pos

FLAG = f"{TARGET}_missing_flag"


def latest_actual(features: DataFrame) -> DataFrame:
    """Last measured row (flag 0) per station, else the last row; with AQI and level."""
    measured = F.col(FLAG) == 0 if FLAG in features.columns else F.lit(True)
    row = F.struct(F.col("date").alias("date"), F.col(TARGET).alias("pm2_5"))
    agg = features.groupBy(KEY).agg(F.max_by(row, F.when(measured, F.col("date"))).alias("_m"),
                                    F.max_by(row, F.col("date")).alias("_l"))
    r = F.coalesce(F.col("_m"), F.col("_l"))
    out = agg.select(KEY, r["date"].alias("date"), r["pm2_5"].alias("pm2_5"))
    aqi = pm25_to_aqi(F.col("pm2_5"))
    return out.withColumn("aqi", aqi).withColumn("level", aqi_label(F.col("aqi"))).withColumn(
        "color", aqi_color(F.col("aqi")))


def sensor_lag_hours(latest: DataFrame, as_of) -> DataFrame:
    """max(0, trunc((as_of - latest) / 1 h))."""
    lag = F.expr("timestampdiff(HOUR, date, _as_of)")  # whole hours between wall-clock values
    return latest.withColumn("_as_of", F.lit(as_of).cast("timestamp_ntz")).withColumn("lag_hours", F.greatest(F.lit(0), lag).cast("long")).drop("_as_of")


def aqi_delta_24h(features: DataFrame) -> DataFrame:
    """AQI of the latest actual minus AQI of the 25th row from the end; a
    station with fewer rows has its AQI and a NULL delta."""
    last = tail_rows(features.select(KEY, "date", TARGET), 25)
    w = Window.partitionBy(KEY).orderBy(F.col("date").desc())  # <= 25 rows per station
    prev = (last.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 25)
                .select(KEY, pm25_to_aqi(F.col(TARGET)).alias("prev_aqi")))
    return latest_actual(features).join(prev, KEY, "left").withColumn("delta_aqi", F.col("aqi") - F.col("prev_aqi"))


def tail_rows(df: DataFrame, k: int, order: str = "date", keys=(KEY,), block: int | None = None) -> DataFrame:
    """Last ``k`` rows per key by ``order`` (exact), without sorting a whole
    group in one task: top-k inside each time block first, then over the
    <= k x blocks candidates."""
    keys = list(keys)
    block = block_hours(df, block)
    d = with_pos(df, order).withColumn(BLK, F.floor(F.col(POS) / block))
    w1 = Window.partitionBy(*keys, BLK).orderBy(F.col(POS).desc())
    cand = d.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r")
    w2 = Window.partitionBy(*keys).orderBy(F.col(POS).desc())
    return cand.withColumn("_r", F.row_number().over(w2)).filter(F.col("_r") <= k).drop("_r", BLK)


def nowcast_validation_frame(features: DataFrame, feature_cols: list[str], hours: int = C.NOWCAST_VALIDATION_HOURS,
                             future_weather: bool = False) -> DataFrame:
    """Last hours+1 measured rows; model inputs taken from the previous measured
    row (weather from the row itself when the model may see future weather)."""
    if FLAG not in features.columns:
        raise KeyError(f"{FLAG} missing: nowcast validation needs measured-row flags")
    m = tail_rows(features.filter(F.col(FLAG) == 0), hours + 1)
    w = Window.partitionBy(KEY).orderBy("date")  # <= hours+1 rows per station
    cols = []
    for c in feature_cols:
        if future_weather and c in C.WEATHER_COLUMNS:
            cols.append(F.col(c).alias(c))
        else:
            cols.append(F.lag(F.col(c), 1).over(w).alias(c))
    return (m.select(KEY, "date", F.col(TARGET).alias("actual"), F.row_number().over(w).alias("_rn"), *cols)
             .filter(F.col("_rn") > 1).drop("_rn"))


def nowcast_validation_mae(scored: DataFrame, pred_col: str = "prediction") -> DataFrame:
    return scored.groupBy(KEY).agg(F.avg(F.abs(F.col(pred_col) - F.col("actual"))).alias("mae"),
                                   F.count(F.lit(1)).alias("n_hours"))


def forecast_rows(features: DataFrame, horizons=None) -> DataFrame:
    """Latest row per station, one copy per horizon with its target time."""
    horizons = horizons or C.HORIZONS
    last = features.groupBy(KEY).agg(F.max("date").alias("_last"))
    rows = features.join(last, KEY).filter(F.col("date") == F.col("_last")).drop("_last")
    rows = rows.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return rows.withColumn("target_time", F.col("date") + F.make_dt_interval(hours=F.col("horizon")))


def with_aqi_level(df: DataFrame, col: str = "prediction") -> DataFrame:
    return (df.withColumn("aqi", pm25_to_aqi(F.col(col))).withColumn("level", aqi_label(F.col("aqi")))
              .withColumn("color", aqi_color(F.col("aqi"))))

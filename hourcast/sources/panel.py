"""Sensor panel derived from the driver tables.

``events`` stands in for landed sensor readings (``event_type`` is the station,
``value`` the reading) and for the weather feed (``props.k``); ``orders`` gives a
long daily series for seasonal operators. Means are built from integer sums so
that every engine computes them bit for bit.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.config import KEY, TIME


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hour(c: str = "ts"):
    """Start of the hour of a TIMESTAMP_NTZ: the value less its minutes and seconds (time-zone free)."""
    return F.expr(f"{c} - make_dt_interval(0, 0, minute({c}), extract(SECOND FROM {c}))")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, unsorted readings with duplicates per hour: (station_id, datetime, seq, pm2_5, pm10)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias(KEY), _hour().alias(TIME), F.col("event_id").alias("seq"),
                     F.col("value").alias("pm2_5"), F.col("value").alias("pm10"))


def aq_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station x hour pollutant table (F3 without partitions)."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    g = ev.groupBy(F.col("event_type").alias(KEY), _hour().alias(TIME)).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.max("value").alias("pm10"),
    )
    return g.select(KEY, TIME, (F.col("_cents") / (F.lit(100.0) * F.col("_n"))).alias("pm2_5"), "pm10")


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather shared by all stations (F4 without partitions)."""
    ev = table(spark, sf_dir, "events").select(_hour().alias(TIME), F.get_json_object("props", "$.k").cast("int").alias("k"))
    return ev.groupBy(TIME).agg(
        (F.sum("k") / (F.lit(1.0) * F.count(F.lit(1)))).alias("temperature_2m"),
        F.max("k").cast("double").alias("relative_humidity_2m"),
        F.min("k").cast("double").alias("wind_speed_10m"),
        (F.lit(1000.0) + F.count(F.lit(1))).alias("pressure_msl"),
        (F.sum(F.col("k") % 7) / (F.lit(1.0) * F.count(F.lit(1)))).alias("precipitation"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: station = order priority, value = mean order price of the day (integer cents)."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias(KEY),
                      F.col("o_orderdate").cast("timestamp_ntz").alias(TIME))
             .agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
                   / (F.lit(100.0) * F.count(F.lit(1)))).alias("pm2_5"),
                  F.count(F.lit(1)).alias("n_orders")))

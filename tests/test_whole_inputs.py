"""Registered queries over the whole of their input."""
from conftest import SF001
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.plans import common as P
from hourcast.plans.queries import REGISTRY
from hourcast.sources import panel as SP


def test_watermarks_reach_the_last_hour_of_every_station(spark):
    aq, weather = SP.aq_hourly(spark, SF001), SP.weather_hourly(spark, SF001)
    last = {r.station_id: r.mx for r in aq.groupBy("station_id").agg(F.max("datetime").alias("mx")).collect()}
    end = weather.agg(F.max("datetime")).first()[0]

    def marks(name):
        return {r.station_id: r.last_data_time for r in REGISTRY[name](spark, SF001).collect()}

    assert marks("high_watermark_all") == last
    assert marks("advance_watermark_all") == {s: min(t, end) for s, t in last.items()}


def test_forecasts_cover_every_hour_and_feature_row(spark):
    weather, rows = SP.weather_hourly(spark, SF001), P.panel_features(spark, SF001)
    times = lambda df, c: {r[0] for r in df.select(c).distinct().collect()}
    assert times(REGISTRY["read_weather_forecast_all"](spark, SF001), "datetime") == times(weather, "datetime")
    got = REGISTRY["inject_future_weather_all"](spark, SF001)
    assert got.count() == got.select("station_id", "date", "horizon").distinct().count() == rows.count() * len(C.HORIZONS)
    c = C.WEATHER_COLUMNS[0]
    known = {r.datetime: r[c] for r in weather.select("datetime", F.round(c, 6).alias(c)).collect()}
    now = {(r.station_id, r.date): r[c] for r in rows.select("station_id", "date", F.round(c, 6).alias(c)).collect()}
    hits = 0
    for r in got.withColumn("at", F.col("date") + F.make_dt_interval(hours=F.col("horizon"))).collect():
        ahead = known.get(r["at"])
        hits += ahead is not None
        assert abs(r[c] - (now[r.station_id, r.date] if ahead is None else ahead)) < 2e-6
    assert 0 < hits < rows.count() * len(C.HORIZONS)


def test_every_horizon_is_served(spark):
    for name in ("window_matrix_all", "time_series_folds_all", "oracle_weather_shift_all", "write_model"):
        got = REGISTRY[name](spark, SF001)
        assert {r.horizon for r in got.select("horizon").distinct().collect()} == set(C.HORIZONS), name

"""Load state, freshness and serving rules on hand-made rows."""
import datetime as dt

import pytest

from hourcast.operators import eda, serve
from hourcast.sources import state as ST

T0 = dt.datetime(2024, 3, 1)
H = dt.timedelta(hours=1)
TIMES = "station_id string, datetime timestamp_ntz"


def test_watermark_rules(spark):
    aq = spark.createDataFrame([("a", T0 + 5 * H), ("b", T0 + 9 * H)], TIMES)
    weather = spark.createDataFrame([(T0 + 7 * H,)], "datetime timestamp_ntz")
    none, no_aq = weather.limit(0), aq.limit(0)
    now = spark.createDataFrame([("a", T0), ("c", T0)], "station_id string, last_data_time timestamp_ntz")

    def marks(*args, **kw):
        return {r.station_id: r.last_data_time for r in ST.advance_watermark(*args, **kw).collect()}

    assert marks(aq, weather, now) == {"a": T0 + 5 * H, "b": T0 + 7 * H, "c": T0 + 7 * H}
    assert marks(no_aq, weather, now) == {"a": T0 + 7 * H, "c": T0 + 7 * H}  # weather only
    assert marks(aq, none, now) == {"a": T0 + 5 * H, "b": T0 + 9 * H, "c": T0}
    assert marks(no_aq, none, now) == {"a": T0, "c": T0}
    assert marks(aq, weather, now, weather_ok=False) == {"a": T0, "b": None, "c": T0}


def test_empty_state_gives_the_default(spark):
    empty = spark.createDataFrame([], "station_id string, last_data_time timestamp_ntz")
    stations = spark.createDataFrame([("a",), ("b",)], "station_id string")
    got = ST.high_watermark(empty, expected=stations).collect()
    assert {(r.station_id, r.last_data_time) for r in got} == {("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))}


def test_staleness_is_strict_and_missing_data_is_an_error(spark):
    f = spark.createDataFrame([("a", T0), ("b", T0 + H)], "station_id string, date timestamp_ntz")
    assert {r.station_id: r.is_stale for r in ST.staleness(f, "2024-03-01 06:00:01").collect()} == {"a": True, "b": False}
    with pytest.raises(Exception, match="no feature time"):
        ST.staleness(spark.createDataFrame([("a", None)], f.schema), "2024-03-01 06:00:00").collect()


def test_tail_is_rows_not_hours(spark):
    rows = [("s", 1, "m", T0 + 2 * i * H, float(i), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "station_id string, horizon int, model string, date timestamp_ntz, y double, yhat double")
    got = eda.pred_vs_actual_tail(df).collect()
    assert sorted(r.y for r in got) == [float(i) for i in range(100, 300)]


def test_delta_keeps_short_stations_and_counts_rows(spark):
    rows = [("long", T0 + 2 * i * H, float(i), 0) for i in range(30)] + [("short", T0 + i * H, 20.0, 0) for i in range(3)]
    f = spark.createDataFrame(rows, "station_id string, date timestamp_ntz, pm2_5 double, pm2_5_missing_flag int")
    got = {r.station_id: (r.aqi, r.prev_aqi, r.delta_aqi) for r in serve.aqi_delta_24h(f).collect()}
    assert got["short"][0] is not None and got["short"][1:] == (None, None)
    aqi = {r.pm2_5: r.aqi for r in serve.latest_actual(f.selectExpr("concat(station_id, pm2_5) station_id", "date", "pm2_5", "pm2_5_missing_flag")).collect()}
    assert got["long"] == (aqi[29.0], aqi[5.0], aqi[29.0] - aqi[5.0])


def test_lag_hours_are_whole_and_never_negative(spark):
    latest = spark.createDataFrame([("a", T0), ("b", T0 + 9 * H)], "station_id string, date timestamp_ntz")
    got = {r.station_id: r.lag_hours for r in serve.sensor_lag_hours(latest, "2024-03-01 05:59:59").collect()}
    assert got == {"a": 5, "b": 0}

"""Forecast modes, seasons over a whole year, history guard, thresholds, Markdown."""
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.operators import backtest as BT
from hourcast.operators import eda as ED
from hourcast.operators import features as FE
from hourcast.plans import benchmark as BM
from hourcast.sources import files as FL

START = datetime(2024, 1, 1)


def hours(spark, n, step=1):
    return spark.createDataFrame([("s", START + timedelta(hours=i * step), float(i)) for i in range(n)], "station_id string, datetime timestamp_ntz, pm2_5 double")


def test_seasons_of_a_whole_year(spark):
    days = hours(spark, 366, 24)
    flags = FE.season_flags(FE.calendar_features(days)).select(F.month("datetime").alias("m"), "is_winter", "is_summer").distinct().collect()
    assert {r.m for r in flags if r.is_winter} == set(C.WINTER_MONTHS) and {r.m for r in flags if r.is_summer} == set(C.SUMMER_MONTHS)
    preds = days.select("station_id", F.lit(24).alias("horizon"), F.lit("m").alias("model"), F.col("datetime").alias("date"), F.lit(10.0).alias("y"),
                        (10.0 + F.month("datetime")).alias("yhat"))
    k5 = BT.backtest_k5(preds).first()
    assert (k5.count_winter, k5.count_summer) == (31 + 29 + 31, 92) and abs(k5.mae_summer - (30 * 6 + 31 * 7 + 31 * 8) / 92) < 1e-9
    by = {r.season: (r.n, r.mae) for r in BT.backtest_by_season(preds).collect()}
    assert {s: n for s, (n, _) in by.items()} == {"DJF": 91, "MAM": 92, "JJA": 92, "SON": 91}
    assert abs(by["MAM"][1] - (31 * 3 + 30 * 4 + 31 * 5) / 92) < 1e-9


def test_short_history_is_an_error(spark):
    f = hours(spark, 30).withColumnRenamed("datetime", "date")
    row = FE.latest_feature_row(f, ["pm2_5", "pm2_5_seq_lag_1", "pm2_5_seq_lag_30"]).first()
    assert (row.pm2_5, row.pm2_5_seq_lag_1, row.pm2_5_seq_lag_30) == (29.0, 29.0, 0.0)
    with pytest.raises(PySparkException, match="not enough history to build pm2_5_seq_lag_31 of station s"):
        FE.latest_feature_row(f, ["pm2_5", "pm2_5_seq_lag_31"]).collect()


def test_the_mode_is_part_of_the_series(spark):
    n = 60
    f = hours(spark, n).withColumnRenamed("datetime", "date")
    f = f.select("*", *[F.col("pm2_5").alias(c) for c in C.FEATURES if c != "pm2_5"])
    for h in (1, 3):
        f = f.withColumn(f"target_pm2_5_t{h}", F.when(F.col("pm2_5") < n - h, F.col("pm2_5") + h))
    split = BM.split_by_mode(f, [1, 3])
    rows = split.select("mode", "horizon", "pm2_5", "temperature_2m", "y", "idx", "n").collect()
    assert all(r.temperature_2m == r.pm2_5 + (r.horizon if r.mode == "oracle_weather" else 0) and r.y == r.pm2_5 + r.horizon for r in rows)
    assert {(r.mode, r.horizon, r.n) for r in rows} == {(m, h, n - h) for m in C.FORECAST_MODES for h in (1, 3)}


def test_thresholds_and_markdown(spark, tmp_path):
    t = spark.createDataFrame([("s", 35.5), ("t", 60.0), ("u", None)], "station_id string, daily_mean double")
    got = {r.station_id: (r.above_0, r.above_1) for r in ED.with_thresholds(t).collect()}
    assert got == {"s": (False, False), "t": (True, True), "u": (None, None)}
    FL.write_markdown(t, f"file://{tmp_path}/md", ["station_id", "daily_mean"], ["station_id"])
    text = next((tmp_path / "md").glob("part-*")).read_text()
    assert text == "| station_id | daily_mean |\n| --- | --- |\n| s | 35.5 |\n| t | 60.0 |\n| u |  |\n"


def test_kept_results_are_those_of_the_files_as_they_are(spark, tmp_path):
    from hourcast.session import input_stamp
    (tmp_path / "t.parquet").mkdir()
    (tmp_path / "t.parquet" / "a").write_text("1")
    before = input_stamp(spark, f"file://{tmp_path}")
    assert before == input_stamp(spark, f"file://{tmp_path}")
    (tmp_path / "t.parquet" / "b").write_text("2")
    assert before != input_stamp(spark, f"file://{tmp_path}")

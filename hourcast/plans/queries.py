"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from hourcast.plans import common as P
from hourcast.operators import clean as CL
from hourcast.sources import panel as SP

REGISTRY: dict = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@query("hourly_grid")
def q_hourly_grid(spark, sf):
    g = CL.hourly_grid(SP.aq_hourly(spark, sf), SP.weather_hourly(spark, sf))
    return P.rounded(g)


@query("clean_series")
def q_clean_series(spark, sf):
    return P.rounded(P.panel_clean(spark, sf))


@query("build_features")
def q_build_features(spark, sf):
    return P.rounded(P.panel_features(spark, sf))


# ---------------------------------------------------------------- prep / split
from hourcast.plans import benchmark as BM  # noqa: E402
from hourcast.operators import select as SEL  # noqa: E402
from hourcast.operators import metrics as MET  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _features(spark, sf):
    return P.panel_features(spark, sf)


def _split(spark, sf):
    return P.panel_split(spark, sf)


@query("valid_rows")
def q_valid_rows(spark, sf):
    from hourcast.operators.prep import valid_rows_all
    v = valid_rows_all(_features(spark, sf))
    return P.rounded(v.select("station_id", "horizon", "date", "y"))


@query("chrono_split")
def q_chrono_split(spark, sf):
    s = _split(spark, sf)
    return P.rounded(s.select("station_id", "horizon", "date", "idx", "n", "split", "y"))


@query("persistence")
def q_persistence(spark, sf):
    return P.rounded(BM.baseline_predictions(_split(spark, sf), only="Persistence"))


@query("seasonal_naive")
def q_seasonal_naive(spark, sf):
    s = _split(spark, sf)
    a = BM.baseline_predictions(s, only="SeasonalNaive_24h")
    b = BM.baseline_predictions(s, only="SeasonalNaive_168h")
    return P.rounded(a.unionByName(b))


@query("rolling_mean_baseline")
def q_rolling_mean(spark, sf):
    s = _split(spark, sf)
    a = BM.baseline_predictions(s, only="RollingMean_24h")
    b = BM.baseline_predictions(s, only="RollingMean_168h")
    return P.rounded(a.unionByName(b))


@query("persistence_metrics")
def q_persistence_metrics(spark, sf):
    """Flagship: how good is persistence per station and horizon?"""
    return MET.regression_metrics(BM.baseline_predictions(_split(spark, sf), only="Persistence"))


@query("regression_metrics")
def q_regression_metrics(spark, sf):
    return MET.regression_metrics(BM.baseline_predictions(_split(spark, sf)))


@query("rank_models")
def q_rank_models(spark, sf):
    m = BM.baseline_metrics(_split(spark, sf))
    return SEL.rank_models(m).select("station_id", "mode", "horizon", "model", "MAE", "rank_mae")


@query("select_champion")
def q_select_champion(spark, sf):
    m = BM.baseline_selection(_split(spark, sf))
    return m.select("station_id", "mode", "horizon", "model", "MAE", "rank_mae", "selected_champion")


# ---------------------------------------------------------------- cleaning ops
from hourcast import config as C  # noqa: E402
from hourcast.operators import features as FE  # noqa: E402
from hourcast.operators.series import POS  # noqa: E402

MEAS = C.MEASURES


def _grid(spark, sf, trim=False):
    return CL.hourly_grid(SP.aq_hourly(spark, sf), SP.weather_hourly(spark, sf), trim=trim)


@query("dedupe_hourly")
def q_dedupe(spark, sf):
    return P.rounded(CL.dedupe_hourly(SP.readings(spark, sf)))


@query("merge_outer")
def q_merge_outer(spark, sf):
    return P.rounded(CL.merge_outer(SP.aq_hourly(spark, sf), SP.weather_hourly(spark, sf)))


@query("drop_partition_cols")
def q_drop_partition_cols(spark, sf):
    aq = SP.aq_hourly(spark, sf).withColumn("year", F.year("datetime")).withColumn("month", F.month("datetime"))
    return P.rounded(CL.drop_partition_cols(aq))


@query("detect_time_column")
def q_detect_time(spark, sf):
    w = SP.weather_hourly(spark, sf).withColumnRenamed("datetime", "time")
    w = w.withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm"))
    return P.rounded(CL.detect_time_column(w))


@query("trim_leading_missing")
def q_trim(spark, sf):
    return P.rounded(CL.trim_leading_missing(_grid(spark, sf)))


@query("null_outliers")
def q_null_outliers(spark, sf):
    return P.rounded(CL.null_outliers(_grid(spark, sf, True)))


@query("missing_flags")
def q_missing_flags(spark, sf):
    g = CL.null_outliers(_grid(spark, sf, True))
    return P.rounded(CL.missing_flags(g, MEAS)).select("station_id", "datetime",
                                                        *[f"{c}_missing_flag" for c in MEAS])


@query("interpolate_capped")
def q_interpolate(spark, sf):
    return P.rounded(CL.interpolate_capped(CL.null_outliers(_grid(spark, sf, True)), MEAS))


@query("forward_fill")
def q_ffill(spark, sf):
    return P.rounded(CL.forward_fill(CL.null_outliers(_grid(spark, sf, True)), MEAS))


@query("leading_fill")
def q_leading_fill(spark, sf):
    return P.rounded(CL.leading_fill(CL.null_outliers(_grid(spark, sf, True)), MEAS))


@query("missing_report")
def q_missing_report(spark, sf):
    return CL.missing_report(_grid(spark, sf, True), MEAS)


# ---------------------------------------------------------------- feature ops
def _clean(spark, sf):
    return P.panel_clean(spark, sf)


@query("calendar_features")
def q_calendar(spark, sf):
    return FE.calendar_features(_clean(spark, sf)).select(
        "station_id", "datetime", "hour", "day_of_week", "month", "day_of_year", "year")


@query("season_flags")
def q_season(spark, sf):
    return FE.season_flags(FE.calendar_features(_clean(spark, sf))).select(
        "station_id", "datetime", "is_weekend", "is_winter", "is_summer", "season")


@query("cyclical_features")
def q_cyclical(spark, sf):
    df = FE.cyclical_features(FE.calendar_features(_clean(spark, sf)))
    return P.rounded(df.select("station_id", "datetime", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
                               "month_sin", "month_cos"))


def _sel(df, cols):
    return P.rounded(df.select("station_id", "datetime", *cols))


@query("lag_features")
def q_lags(spark, sf):
    return _sel(FE.lag_features(_clean(spark, sf)), [f"pm2_5_lag_{k}" for k in C.LAGS])


ROLL_COLS = [f"pm2_5_roll{n}_mean" for n in C.ROLL_MEANS] + ["pm2_5_roll24_std", "pm2_5_roll24_max"]


@query("rolling_features")
def q_rolling(spark, sf):
    return _sel(FE.rolling_features(_clean(spark, sf)), ROLL_COLS)


@query("trend_features")
def q_trend(spark, sf):
    return _sel(FE.trend_features(_clean(spark, sf)), ["pm2_5_diff_1h", "pm2_5_diff_24h"])


@query("ratio_features")
def q_ratio(spark, sf):
    return _sel(FE.ratio_features(_clean(spark, sf)), ["pm25_pm10_ratio"])


@query("horizon_targets")
def q_targets(spark, sf):
    return _sel(FE.horizon_targets(_clean(spark, sf)), [FE.target_col(h) for h in C.HORIZONS])


@query("target_coverage")
def q_target_coverage(spark, sf):
    return FE.target_coverage(FE.horizon_targets(_clean(spark, sf)))


@query("drop_incomplete_inference")
def q_drop_inf(spark, sf):
    return P.panel_features(spark, sf).select("station_id", "date")


@query("drop_incomplete_training")
def q_drop_train(spark, sf):
    return P.panel_features(spark, sf, is_inference=False).select("station_id", "date")


def _window_rows(spark, sf):
    """168-lag windows of the masked rows of every horizon, kept for train and test rows."""
    wm = FE.window_matrix(_split(spark, sf))
    wm = wm.filter(F.col("split").isin("train", "test"))
    return wm.select("station_id", "horizon", "date", "split", P.r6(F.col("window")[0]).alias("lag_1"),
                     P.r6(F.col("window")[167]).alias("lag_168"),
                     P.r6(F.aggregate("window", F.lit(0.0), lambda a, x: a + x)).alias("window_sum"))


@query("window_matrix")
def q_window_matrix(spark, sf):
    """The windows of h=24."""
    return _window_rows(spark, sf).filter(F.col("horizon") == 24).drop("horizon")


REGISTRY["window_matrix_all"] = _window_rows


# ---------------------------------------------------------------- AQI and scalar functions
from hourcast.functions import aqi as AQ  # noqa: E402
from hourcast.functions import text as TX  # noqa: E402


def _values(spark, sf):
    return SP.table(spark, sf, "events").select("event_id", "value")


@query("pm25_to_aqi")
def q_pm25_to_aqi(spark, sf):
    return _values(spark, sf).select("event_id", "value", AQ.pm25_to_aqi("value").alias("aqi"))


@query("aqi_to_level")
def q_aqi_to_level(spark, sf):
    a = _values(spark, sf).select("event_id", AQ.pm25_to_aqi("value").alias("aqi"))
    lv = AQ.aqi_to_level(F.col("aqi"))
    return a.select("event_id", "aqi", lv["label"].alias("label"), lv["color"].alias("color"))


def _level_dim(spark):
    rows = [(i, C.AQI_LEVELS[i][1], C.AQI_LEVELS_US[i], C.AQI_LEVELS_VN[i], C.AQI_COLORS[i],
             C.AQI_BREAKPOINTS[i], C.AQI_BREAKPOINTS[i + 1]) for i in range(len(C.AQI_LEVELS))]
    return spark.createDataFrame(rows, "level_idx int, label string, label_us string, label_vn string, "
                                       "color_lower string, aqi_low int, aqi_high int")


@query("aqi_labels")
def q_aqi_labels(spark, sf):
    """Alternative label sets via a broadcast join of the fixed 6-row level dimension."""
    a = _values(spark, sf).select("event_id", AQ.pm25_level_index("value").alias("level_idx"))
    dim = _level_dim(spark).drop("label")
    return a.join(F.broadcast(dim), "level_idx", "left")


@query("aqi_advice")
def q_aqi_advice(spark, sf):
    a = _values(spark, sf).select("event_id", AQ.pm25_level("value").alias("label"))
    adv = spark.createDataFrame(list(C.AQI_ADVICE.items()), "label string, advice string")
    j = a.join(F.broadcast(adv), "label", "left")
    return j.select("event_id", "label", F.coalesce("advice", F.lit(C.AQI_ADVICE_DEFAULT)).alias("advice"))


@query("is_unhealthy")
def q_is_unhealthy(spark, sf):
    return _values(spark, sf).select("event_id", AQ.is_unhealthy("value").alias("is_unhealthy"))


@query("safe_model_name")
def q_safe_model_name(spark, sf):
    p = SP.table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" (v1/"), "p_brand", F.lit(")"))
                                           .alias("name"))
    return p.select("p_partkey", TX.safe_model_name("name").alias("safe_name"))


@query("parse_horizons")
def q_parse_horizons(spark, sf):
    o = SP.table(spark, sf, "orders").select(
        "o_orderkey", F.concat_ws(",", (F.col("o_custkey") % 100).cast("string"), F.lit(" "),
                                  (F.col("o_orderkey") % 72).cast("string")).alias("spec"))
    return o.select("o_orderkey", F.array_join(TX.parse_horizons("spec"), "|").alias("horizons"))


# ---------------------------------------------------------------- prep
from hourcast.operators import prep as PR  # noqa: E402
from hourcast.operators import baselines as BL  # noqa: E402


def _weather_shift(spark, sf, horizon):
    return PR.oracle_weather_shift(_features(spark, sf), horizon, "oracle_weather")


@query("oracle_weather_shift")
def q_oracle_weather(spark, sf):
    return P.rounded(_weather_shift(spark, sf, 24).select("station_id", "date", *C.WEATHER_COLUMNS))


@query("oracle_weather_shift_all")
def q_oracle_weather_all(spark, sf):
    """The shift of every horizon."""
    parts = [_weather_shift(spark, sf, h).select("station_id", F.lit(h).alias("horizon"), "date", *C.WEATHER_COLUMNS)
             for h in C.HORIZONS]
    return P.rounded(reduce(DataFrame.unionByName, parts))


@query("time_series_folds_all")
def q_folds_all(spark, sf):
    """The folds of every horizon."""
    s = PR.train_valid_union(_split(spark, sf)).drop("idx", "n")
    return PR.time_series_folds(s).select("station_id", "horizon", "date", "fold", "role")


@query("time_series_folds")
def q_folds(spark, sf):
    return q_folds_all(spark, sf).filter(F.col("horizon") == 24).drop("horizon")


@query("rolling_origin_windows")
def q_rolling_origin(spark, sf):
    s = _features(spark, sf).select("station_id", "date", POS, "pm2_5")
    return P.rounded(PR.rolling_origin_windows(s).select(
        "station_id", "date", "window", "cutoff_idx", "forecast_horizon", "pm2_5"))


@query("train_valid_union")
def q_tv_union(spark, sf):
    return PR.train_valid_union(_split(spark, sf)).select("station_id", "horizon", "date", "split")


# ---------------------------------------------------------------- legacy baselines, metrics, selection
def _preds(spark, sf):
    return BM.baseline_predictions(_split(spark, sf))


@query("naive_legacy")
def q_naive_legacy(spark, sf):
    return P.rounded(BL.naive_legacy(_split(spark, sf)))


@query("seasonal_naive_legacy")
def q_snaive_legacy(spark, sf):
    return P.rounded(BL.seasonal_naive_legacy(_split(spark, sf), 168))


@query("mae_rmse_r2")
def q_mae_rmse_r2(spark, sf):
    return MET.mae_rmse_r2(_preds(spark, sf))


@query("aqi_confusion")
def q_confusion(spark, sf):
    return MET.aqi_confusion(_preds(spark, sf))


@query("aqi_accuracy")
def q_accuracy(spark, sf):
    return MET.aqi_accuracy(_preds(spark, sf))


@query("f1_macro")
def q_f1(spark, sf):
    return MET.f1_macro(_preds(spark, sf))


@query("recall_unhealthy")
def q_recall(spark, sf):
    return MET.recall_unhealthy(_preds(spark, sf))


def _selection(spark, sf):
    return BM.baseline_selection(_split(spark, sf))


SEL_COLS = ["station_id", "mode", "horizon", "model", "group", "MAE", "rank_mae", "selected_champion"]


@query("deployable_champion")
def q_deployable(spark, sf):
    return SEL.deployable_champion(_selection(spark, sf))


@query("leaderboard")
def q_leaderboard(spark, sf):
    return SEL.leaderboard(_selection(spark, sf)).select(*SEL_COLS)


@query("final_leaderboard")
def q_final_leaderboard(spark, sf):
    return SEL.final_leaderboard(_selection(spark, sf)).select(*SEL_COLS)


@query("combined_leaderboard")
def q_combined(spark, sf):
    return SEL.combined_leaderboard(_selection(spark, sf)).select(
        "station_id", "horizon", "model", "group", "tuned", "MAE", "group_order", "position")


@query("compare_models")
def q_compare(spark, sf):
    return SEL.compare_models(BM.baseline_metrics(_split(spark, sf))).select(
        "station_id", "horizon", "model", "MAE", "avg_rank")


@query("metrics_union")
def q_metrics_union(spark, sf):
    s = _split(spark, sf)
    a = BM.baseline_metrics(s, mode="operational")
    b = BM.baseline_metrics(s, mode="oracle_weather")
    return SEL.metrics_union(a, b).select("mode", "station_id", "horizon", "model", "MAE", "RMSE", "R2", "n_test")


@query("skip_report")
def q_skip_report(spark, sf):
    """Models that are not run, with the published reasons, for every station of the data."""
    stations = _split(spark, sf).select("station_id").distinct()
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(r).alias("reason")) for m, r in C.SKIPPED_MODELS])).alias("s")
    return stations.select("station_id", rows).select("station_id", "s.model", F.lit("skipped").alias("status"), "s.reason")


# ---------------------------------------------------------------- backtests
from hourcast.operators import backtest as BT  # noqa: E402


@query("backtest_k1_k3")
def q_k1_k3(spark, sf):
    return P.rounded(BT.backtest_k1_k3(_preds(spark, sf)))


@query("backtest_k4")
def q_k4(spark, sf):
    return P.rounded(BT.backtest_k4(_preds(spark, sf)))


@query("backtest_k5")
def q_k5(spark, sf):
    return P.rounded(BT.backtest_k5(_preds(spark, sf)))


# ---------------------------------------------------------------- EDA
from hourcast.operators import eda as ED  # noqa: E402


@query("daily_trend")
def q_daily_trend(spark, sf):
    return P.rounded(ED.daily_trend(SP.daily_series(spark, sf)))


@query("seasonal_decompose")
def q_decompose(spark, sf):
    return P.rounded(ED.seasonal_decompose(_clean(spark, sf)))


@query("box_by_month")
def q_box_month(spark, sf):
    return P.rounded(ED.box_by_month(SP.daily_series(spark, sf)))


@query("box_by_hour")
def q_box_hour(spark, sf):
    return P.rounded(ED.box_by_hour(_clean(spark, sf)))


@query("hour_dow_pivot")
def q_pivot(spark, sf):
    return P.rounded(ED.hour_dow_pivot(_clean(spark, sf)))


@query("acf")
def q_acf(spark, sf):
    return P.rounded(ED.acf(_clean(spark, sf)))


@query("pacf")
def q_pacf(spark, sf):
    return P.rounded(ED.pacf(ED.acf(_clean(spark, sf))))


@query("spearman_matrix")
def q_spearman(spark, sf):
    return P.rounded(ED.spearman_matrix(_clean(spark, sf)))


@query("missing_by_month")
def q_missing_month(spark, sf):
    return P.rounded(ED.missing_by_month(_clean(spark, sf)))


@query("pred_vs_actual_tail")
def q_tail(spark, sf):
    return P.rounded(ED.pred_vs_actual_tail(_preds(spark, sf)).select("station_id", "horizon", "model", "date", "y", "yhat"))


# ---------------------------------------------------------------- serving
from hourcast.operators import serve as SV  # noqa: E402


#: 'now' of the serving queries: after the event month; exactly at the age limit of its last hour, and past it.
AS_OF_LAG, AS_OF_STALE = "2024-01-31 02:30:00", ("2024-01-31 05:00:00", "2024-01-31 05:00:01")


@query("latest_actual")
def q_latest(spark, sf):
    return P.rounded(SV.latest_actual(_features(spark, sf)))


@query("sensor_lag_hours")
def q_sensor_lag(spark, sf):
    f = _features(spark, sf)
    return SV.sensor_lag_hours(SV.latest_actual(f), AS_OF_LAG).select("station_id", "date", "lag_hours")


@query("aqi_delta_24h")
def q_aqi_delta(spark, sf):
    return SV.aqi_delta_24h(_features(spark, sf)).select("station_id", "aqi", "prev_aqi", "delta_aqi")


@query("nowcast_validation")
def q_nowcast_validation(spark, sf):
    """Nowcast validation of the persistence nowcaster (input = previous measured pm2_5)."""
    fr = SV.nowcast_validation_frame(_features(spark, sf), ["pm2_5"])
    return P.rounded(SV.nowcast_validation_mae(fr.withColumn("prediction", F.col("pm2_5"))))


# ---------------------------------------------------------------- state and sources
from hourcast.sources import state as ST  # noqa: E402
from hourcast.sources import files as FL  # noqa: E402


@query("filter_time_range")
def q_filter_time_range(spark, sf):
    aq = SP.aq_hourly(spark, sf)
    return P.rounded(FL.filter_time_range(aq, "2024-01-05 00:00:00", "2024-01-20 00:00:00", "2024-01-15 12:00:00"))


@query("plan_time_chunks")
def q_chunks(spark, sf):
    r = SP.table(spark, sf, "orders").agg(F.min("o_orderdate").cast("timestamp_ntz").alias("start"),
                                          F.max("o_orderdate").cast("timestamp_ntz").alias("end"))
    return FL.plan_time_chunks(r).select("chunk_start", "chunk_end")


@query("read_partitioned")
def q_read_partitioned(spark, sf):
    from hourcast.session import ensure_checkpoint_dir
    import uuid
    lake = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex[:8]}"
    FL.append_partitioned(SP.aq_hourly(spark, sf), lake, "aq")
    return P.rounded(FL.read_partitioned(spark, lake, "aq"))


@query("read_features")
def q_read_features(spark, sf):
    """The written feature table, found as the fallback of a path that does not exist."""
    path = _scratch(spark, "features")
    FL.write_features(_features(spark, sf), path)
    f = FL.read_features(spark, path + "-missing", fallback=path)
    return P.rounded(f.select("station_id", "date", "pm2_5", "pm2_5_lag_24", "target_pm2_5_t24"))


@query("high_watermark")
def q_high_watermark(spark, sf):
    """State of a load that stopped on 10 January and never reached one station, which gets the default."""
    stations = SP.table(spark, sf, "events").select(F.col("event_type").alias("station_id"))
    state = SP.aq_hourly(spark, sf).filter("datetime < timestamp_ntz'2024-01-10 00:00:00' and station_id <> 'click'")
    return ST.high_watermark(state.select("station_id", F.col("datetime").alias("last_data_time")), expected=stations)


@query("advance_watermark")
def q_advance_watermark(spark, sf):
    """One station has weather only, one readings that end before the weather, the others after it."""
    aq = SP.aq_hourly(spark, sf)
    known = aq.groupBy("station_id").agg(F.min("datetime").alias("last_data_time"))
    loaded = aq.filter("station_id <> 'click' and (station_id <> 'error' or datetime < timestamp_ntz'2024-01-15 00:00:00')")
    weather = SP.weather_hourly(spark, sf).filter("datetime < timestamp_ntz'2024-01-20 00:00:00'")
    return ST.advance_watermark(loaded, weather, known)


@query("high_watermark_all")
def q_high_watermark_all(spark, sf):
    """State of a load of every station-hour."""
    stations = SP.table(spark, sf, "events").select(F.col("event_type").alias("station_id"))
    state = SP.aq_hourly(spark, sf).select("station_id", F.col("datetime").alias("last_data_time"))
    return ST.high_watermark(state, expected=stations)


@query("advance_watermark_all")
def q_advance_watermark_all(spark, sf):
    """Every station-hour and all weather loaded, beside the state of a load that had each station's first hour."""
    aq = SP.aq_hourly(spark, sf)
    known = aq.groupBy("station_id").agg(F.min("datetime").alias("last_data_time"))
    return ST.advance_watermark(aq, SP.weather_hourly(spark, sf), known)


@query("needs_rebuild")
def q_needs_rebuild(spark, sf):
    raw = SP.aq_hourly(spark, sf).groupBy("station_id").agg(F.max("datetime").alias("max_time"))
    feat = _features(spark, sf).groupBy("station_id").agg(F.max("date").alias("max_time"))
    return ST.needs_rebuild(raw, feat)


@query("staleness")
def q_staleness(spark, sf):
    """At the age limit (not stale) and a second later (stale)."""
    f = _features(spark, sf)
    at, late = (ST.staleness(f, t).withColumn("as_of", F.lit(t)) for t in AS_OF_STALE)
    return at.unionByName(late)


# ---------------------------------------------------------------- models (rows-only checks; numpy parity in tests)
from hourcast.plans import models as PMOD  # noqa: E402
from hourcast.operators import models as MOD  # noqa: E402


def _spec(name):
    return {s.name: s for s in PMOD.model_specs()}[name]


def _model_query(name, tune=False):
    def q(spark, sf):
        return P.rounded(PMOD.fit_predict(_split(spark, sf), _spec(name), tune, memo=P.memo(spark, sf))[0])
    return q


for _qid, _name, _tune in (("ridge", "Ridge", False), ("elastic_net", "ElasticNet", False),
                           ("ols", "LinearRegression", False), ("window_ridge", "WindowRidge_168h", False),
                           ("dlinear", "DLinear", False), ("nlinear", "NLinear", False),
                           ("fourier_regression", "FourierRegression", False),
                           ("arma_regression", "SARIMAX", False), ("random_forest", "RandomForest", False),
                           ("extra_trees", "ExtraTrees", False), ("gbt", "XGBoost", False),
                           ("gbt_leafwise", "LightGBM", False), ("gbt_oblivious", "CatBoost", False),
                           ("tune", "Ridge", True), ("fit_predict", "ElasticNet", True)):
    REGISTRY[_qid] = _model_query(_name, _tune)


@query("cross_validate")
def q_cross_validate(spark, sf):
    tv = PR.train_valid_union(_split(spark, sf))
    return P.rounded(MOD.cross_validate(tv, C.FEATURES, "ridge", {"alpha": 1.0}))


@query("refit_full")
def q_refit_full(spark, sf):
    """Coefficients of the export model fitted on all valid rows of each series."""
    c = MOD.fit_linear_grid(_split(spark, sf), C.FEATURES, ["station_id", "horizon"], "ridge", [{"alpha": 1.0}])
    names = F.array(*[F.lit(x) for x in C.FEATURES])
    return P.rounded(c.select("station_id", "horizon", "intercept", F.inline(F.arrays_zip(names.alias("feature"), F.col("coef").alias("weight")))))


@query("benchmark")
def q_benchmark(spark, sf):
    """Baselines and every model spec, the linear ones tuned, metrics and champion rule."""
    met, _ = PMOD.benchmark(_split(spark, sf), PMOD.model_specs(), BM.baseline_metrics(_split(spark, sf)), tune=True, memo=P.memo(spark, sf))
    return met.select("station_id", "mode", "horizon", "model", "group", "complexity_rank", "MAE", "RMSE", "R2",
                      "n_test", "rank_mae", "selected_champion")


# ---------------------------------------------------------------- streaming (rows-only; batch = stream in tests)
from hourcast.streaming import ingest as STR  # noqa: E402


@query("stream_hourly_avg")
def q_stream_hourly_avg(spark, sf):
    out = STR.run_available(spark, STR.stream_hourly_avg(STR.read_readings_stream(spark, sf)), "hourly")
    return P.rounded(out.drop("year", "month"))


@query("stream_dedupe")
def q_stream_dedupe(spark, sf):
    """A stream in which every seventh reading was fetched twice."""
    landed = _scratch(spark, "landed")
    ev = SP.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    ev.write.parquet(landed)
    ev.filter("event_id % 7 = 0").write.mode("append").parquet(landed)
    out = STR.run_available(spark, STR.stream_dedupe(STR.read_readings_stream(spark, landed, "*.parquet")), "dedupe")
    return P.rounded(out.select("station_id", "event_id", "value"))


@query("stream_append")
def q_stream_append(spark, sf):
    return P.rounded(STR.run_available(spark, STR.stream_hourly_avg(STR.read_readings_stream(spark, sf)), "append"))


# ---------------------------------------------------------------- explainability (rows-only; additivity in tests)
from hourcast.operators import explain as EX  # noqa: E402
from hourcast.operators import trees as MOD_T  # noqa: E402


def _ridge_fit(spark, sf):
    s = _split(spark, sf)
    tr = s.filter(F.col("split") == "train")
    coefs = MOD.fit_linear_grid(tr, C.FEATURES, ["station_id", "horizon"], "ridge", [{"alpha": 1.0}])
    return s, tr, coefs


@query("shapley_summary")
def q_shap_summary(spark, sf):
    s, tr, coefs = _ridge_fit(spark, sf)
    return P.rounded(EX.shapley_summary(EX.shapley_linear(tr, tr, coefs, C.FEATURES)))


@query("shapley_extreme_row")
def q_shap_extreme(spark, sf):
    s, tr, coefs = _ridge_fit(spark, sf)
    return P.rounded(EX.shapley_extreme_row(s.filter(F.col("split") == "test"), tr, coefs, C.FEATURES))


@query("permutation_importance")
def q_perm_importance(spark, sf):
    s, tr, coefs = _ridge_fit(spark, sf)
    return P.rounded(EX.permutation_importance(s.filter(F.col("split") == "test"), coefs, C.FEATURES))


def _boosted(spark, sf):
    s = _split(spark, sf)
    return s, PMOD.tree_models(s.filter(F.col("split") == "train"), MOD_T.params_of("XGBoost"))


@query("shapley_summary_trees")
def q_shap_summary_trees(spark, sf):
    """Mean attributions of the boosted model of every series over its test rows."""
    s, models = _boosted(spark, sf)
    return P.rounded(EX.shapley_summary(EX.shapley_trees(s.filter(F.col("split") == "test"), models, C.FEATURES)))


@query("shapley_extreme_row_trees")
def q_shap_extreme_trees(spark, sf):
    s, models = _boosted(spark, sf)
    return P.rounded(EX.shapley_trees(EX.extreme_rows(s.filter(F.col("split") == "test"), C.FEATURES), models, C.FEATURES))


@query("permutation_importance_models")
def q_perm_importance_models(spark, sf):
    """Of the ridge and the boosted model of every series, by the same shuffles."""
    s, models = _boosted(spark, sf)
    test = s.filter(F.col("split") == "test")
    _, _, coefs = _ridge_fit(spark, sf)
    ridge = EX.importance_of(test, coefs.select("station_id", "horizon", "intercept", "coef"), C.FEATURES, EX.predict_coefficients)
    trees = EX.importance_of(test, models, C.FEATURES, MOD_T.predicted)
    return P.rounded(ridge.withColumn("model", F.lit("Ridge")).unionByName(trees.withColumn("model", F.lit("XGBoost"))))


# ---------------------------------------------------------------- model serving
@query("forecast_horizons")
def q_forecast_horizons(spark, sf):
    """Latest row of every station scored by its per-horizon ridge -> AQI level."""
    s, tr, coefs = _ridge_fit(spark, sf)
    rows = SV.forecast_rows(_features(spark, sf))
    pred = MOD.predict_linear(rows, coefs.drop("param_id", "params"), C.FEATURES, "prediction")
    return P.rounded(SV.with_aqi_level(pred.select("station_id", "horizon", "date", "target_time", "prediction")))


@query("nowcast")
def q_nowcast(spark, sf):
    """h=1 champion-style nowcast from the last row of each station."""
    s, tr, coefs = _ridge_fit(spark, sf)
    rows = SV.forecast_rows(_features(spark, sf), [1])
    pred = MOD.predict_linear(rows, coefs.drop("param_id", "params"), C.FEATURES, "prediction")
    return P.rounded(SV.with_aqi_level(pred.select("station_id", "date", "target_time", "prediction")))


# ---------------------------------------------------------------- file sources and sinks (write, then read back)
import uuid as _uuid  # noqa: E402

from hourcast.session import ensure_checkpoint_dir as _ckpt  # noqa: E402


def _scratch(spark, name):
    return f"{_ckpt(spark).rstrip('/')}/{name}-{_uuid.uuid4().hex[:8]}"


@query("read_aq_csv")
def q_read_aq_csv(spark, sf):
    """Readings landed as sensor CSV (epoch seconds, dotted column names), read back typed in local time."""
    ev = SP.table(spark, sf, "events")
    path = _scratch(spark, "aq-csv")
    (ev.select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("time_stamp"),
               F.col("value").alias("pm2.5_atm"), (F.col("value") * 2).alias("pm10.0_atm"))
       .write.option("header", True).csv(path))
    return P.rounded(FL.read_aq_csv(spark, path, "sensor"))


def _field(name):
    return lambda s: s[name]


def _weather_payload_path(spark, sf):
    return _payload_path(spark, SP.weather_hourly(spark, sf))


def _payload_path(spark, weather):
    """Weather landed as JSON payloads of parallel arrays, one file per day that holds one document over many lines."""
    w = weather.withColumn("_day", F.to_date("datetime"))
    doc = w.groupBy("_day").agg(F.struct(
        F.array_sort(F.collect_list(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm"))).alias("time"),
        *[F.transform(F.array_sort(F.collect_list(F.struct(F.col("datetime"), F.col(c)))), _field(c))
          .alias(c) for c in C.WEATHER_COLUMNS]).alias("hourly"))
    path = _scratch(spark, "weather-json")
    text = F.to_json("hourly", {"pretty": "true"})
    (doc.select("_day", F.concat(F.lit('{"hourly": '), text, F.lit("}")).alias("value"))
        .repartition("_day").write.partitionBy("_day").text(path))
    return f"{path}/*"


@query("read_weather_json")
def q_read_weather_json(spark, sf):
    return P.rounded(FL.read_weather_json(spark, _weather_payload_path(spark, sf)))


@query("read_weather_forecast")
def q_read_weather_forecast(spark, sf):
    """Forecast documents, of which one lies ahead of the last measured week."""
    w = SP.weather_hourly(spark, sf).filter("datetime >= timestamp_ntz'2024-01-24 00:00:00'")
    return P.rounded(FL.read_weather_forecast(spark, _payload_path(spark, w)))


@query("read_weather_forecast_all")
def q_read_weather_forecast_all(spark, sf):
    """Forecast documents of every day."""
    return P.rounded(FL.read_weather_forecast(spark, _weather_payload_path(spark, sf)))


@query("append_partitioned")
def q_append_partitioned(spark, sf):
    lake = _scratch(spark, "lake")
    FL.append_partitioned(SP.aq_hourly(spark, sf), lake, "aq")
    return FL.read_partitioned(spark, lake, "aq").groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("localize_time")
def q_localize_time(spark, sf):
    ev = SP.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("datetime"))
    return CL.localize_time(ev.withColumn("datetime", F.to_utc_timestamp("datetime", "UTC")), "datetime")


@query("latest_feature_row")
def q_latest_feature_row(spark, sf):
    cols = ["pm2_5", "pm2_5_lag_1", "pm2_5_roll24_mean", "pm2_5_seq_lag_1", "pm2_5_seq_lag_24", "pm2_5_seq_lag_168"]
    return P.rounded(FE.latest_feature_row(_features(spark, sf), cols))


@query("inject_future_weather")
def q_inject_future_weather(spark, sf):
    """Forecast rows of 29 January: the weather of the next two horizons is known, that of the last is not."""
    known = _features(spark, sf).filter("date <= timestamp_ntz'2024-01-29 00:00:00'")
    rows = SV.forecast_rows(known).select("station_id", "date", "horizon", *C.WEATHER_COLUMNS)
    return P.rounded(FE.inject_future_weather(rows, SP.weather_hourly(spark, sf)))


@query("inject_future_weather_all")
def q_inject_future_weather_all(spark, sf):
    """Every feature row at every horizon: the weather ahead is known for all but the last rows."""
    rows = _features(spark, sf).select("station_id", "date", F.explode(F.array(*[F.lit(h) for h in C.HORIZONS])).alias("horizon"),
                                       *C.WEATHER_COLUMNS)
    return P.rounded(FE.inject_future_weather(rows, SP.weather_hourly(spark, sf)))


@query("compare_cv")
def q_compare_cv(spark, sf):
    tv = PR.train_valid_union(_split(spark, sf))
    parts = [MOD.cross_validate(tv, C.FEATURES, "ridge", {"alpha": a}).withColumn("model", F.lit(f"Ridge_a{a}"))
             for a in (0.1, 10.0)]
    return P.rounded(SEL.compare_models(parts[0].unionByName(parts[1]), by="mae_mean"))


def _champions(spark, sf):
    sel = _selection(spark, sf)
    return sel.filter(F.col("selected_champion") & (F.col("mode") == "operational"))


MANIFEST_SCHEMA = ("station_id string, horizon int, model_name string, artifact_path string, forecast_mode string, "
                   "uses_future_weather_forecast boolean, feature_columns array<string>, target string, "
                   "trained_at string, MAE double, RMSE double, R2 double, recall_unhealthy_plus double, "
                   "mae_top5 double, selection_rule string")


@query("write_manifest")
def q_write_manifest(spark, sf):
    path = _scratch(spark, "manifest")
    FL.write_manifest(FL.manifest_rows(_champions(spark, sf), C.FEATURES), path)
    return FL.read_manifest(spark, path, MANIFEST_SCHEMA).drop("trained_at", "feature_columns")


@query("read_manifest")
def q_read_manifest(spark, sf):
    return q_write_manifest(spark, sf)


@query("champion_entry")
def q_champion_entry(spark, sf):
    return FL.champion_entry(q_write_manifest(spark, sf), 24)


@query("write_model")
def q_write_model(spark, sf):
    """Pooled Spark ML ridge of each horizon saved and loaded back through the candidate list."""
    parts = []
    for h in C.HORIZONS:
        s = _split(spark, sf).filter(F.col("horizon") == h)
        model = MOD.spark_ml_linear(C.FEATURES, reg=0.1).fit(s.filter(F.col("split") == "train"))
        path = _scratch(spark, f"model-t{h}")
        FL.write_model(model, path)
        label, loaded = FL.read_model([("champion", path + "-missing"), ("legacy", path)])
        out = loaded.transform(s.filter(F.col("split") == "test"))
        parts.append(out.select("station_id", "horizon", "date", "y", "yhat", F.lit(label).alias("source")))
    return P.rounded(reduce(DataFrame.unionByName, parts))


@query("read_model")
def q_read_model(spark, sf):
    return q_write_model(spark, sf)


@query("write_model_card")
def q_write_model_card(spark, sf):
    skipped = q_skip_report(spark, sf).select("model", "status", "reason", F.lit("operational").alias("mode")).distinct()
    path = _scratch(spark, "model-card")
    FL.write_model_card(skipped, path, {"scope": "station panel", "primary_mode": "operational"})
    return spark.read.json(f"{path}/skipped")


@query("update_feature_state")
def q_update_feature_state(spark, sf):
    path = _scratch(spark, "feature-state")
    st = ST.feature_state(_features(spark, sf), SP.aq_hourly(spark, sf), generated_at="2024-02-01 00:00:00")
    ST.update_feature_state(st, path)
    return spark.read.parquet(path)


@query("write_features")
def q_write_features(spark, sf):
    path = _scratch(spark, "features")
    FL.write_features(_features(spark, sf).select("station_id", "date", "pm2_5", "target_pm2_5_t1"), path)
    return P.rounded(FL.read_features(spark, path))


@query("write_leaderboards")
def q_write_leaderboards(spark, sf):
    path = _scratch(spark, "reports")
    FL.write_leaderboards(_selection(spark, sf), path)
    return spark.read.parquet(f"{path}/final_leaderboard").select("station_id", "horizon", "model", "MAE")


@query("write_metrics_csv")
def q_write_metrics_csv(spark, sf):
    path = _scratch(spark, "metrics-csv")
    FL.write_metrics_csv(_selection(spark, sf), path)
    m = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return m.select("station_id", "mode", "horizon", "model", "MAE", "RMSE", "R2", "rank_mae", "selected_champion")


@query("write_runtime_csv")
def q_write_runtime_csv(spark, sf):
    path = _scratch(spark, "runtime-csv")
    FL.write_runtime_csv(BM.baseline_metrics(_split(spark, sf)), path)
    r = spark.read.option("header", True).csv(path)
    return r.select("station_id", "mode", F.col("horizon").cast("int").alias("horizon"), "model", "group", "status")


# ---------------------------------------------------------------- champion chain, rolling origins, resumed streams
from hourcast.plans import champion as CH  # noqa: E402

#: Models that compete for deployment in these queries, beside the baselines.
COMPETING = ("Ridge", "ElasticNet", "LinearRegression", "ExtraTrees")
_EXPORTED: dict = {}


def _model_selection(spark, sf):
    """Metrics of the baselines and the competing models, with champion flags."""
    specs = [s for s in PMOD.model_specs() if s.name in COMPETING]
    return PMOD.benchmark(_split(spark, sf), specs, BM.baseline_metrics(_split(spark, sf)), tune=True, memo=P.memo(spark, sf))[0]


def _exported(spark, sf):
    """Champions that this application exported once, loaded again."""
    key = (spark.sparkContext.applicationId, *P.memo(spark, sf))
    if key not in _EXPORTED:
        root = _scratch(spark, "champions")
        CH.export_champions(_model_selection(spark, sf), _split(spark, sf), root)
        _EXPORTED[key] = root
    return CH.Champions(spark, _EXPORTED[key])


@query("deployable_champion_models")
def q_deployable_models(spark, sf):
    """The pick where models compete with the baselines: baselines win some series, which deploy their best model."""
    return CH.champions_to_deploy(_model_selection(spark, sf)).select("station_id", "horizon", "model", "group", "MAE", "rank_mae", "selected_champion")


@query("combined_leaderboard_models")
def q_combined_models(spark, sf):
    return SEL.combined_leaderboard(_model_selection(spark, sf)).select("station_id", "horizon", "model", "group", "tuned", "MAE", "group_order", "position")


@query("export_champions")
def q_export_champions(spark, sf):
    """Manifest of the exported champions, read back."""
    return P.rounded(_exported(spark, sf).manifest.drop("trained_at", "created_at", "feature_columns", "artifact_path"))


@query("champion_forecast")
def q_champion_forecast(spark, sf):
    return P.rounded(CH.forecast(_exported(spark, sf), _features(spark, sf)))


@query("champion_nowcast")
def q_champion_nowcast(spark, sf):
    """As of the hour behind the last one: stations have the row of the previous full hour."""
    f = _features(spark, sf)
    as_of = f.agg(F.max("date") + F.expr("INTERVAL 90 MINUTES")).first()[0]
    return P.rounded(CH.nowcast(_exported(spark, sf), f, as_of))


@query("champion_nowcast_validation")
def q_champion_nowcast_validation(spark, sf):
    return P.rounded(CH.nowcast_validation(_exported(spark, sf), _features(spark, sf)))


@query("champion_cards")
def q_champion_cards(spark, sf):
    """A Markdown card for each champion, written as text files and read back."""
    path = _scratch(spark, "cards")
    CH.cards(_exported(spark, sf)).select("station_id", "horizon", "card").write.partitionBy("station_id", "horizon").option("lineSep", "\n\n").text(path)
    return spark.read.text(path, wholetext=True).select("station_id", "horizon", F.rtrim(F.regexp_replace("value", "- Artifact: .*\n*", "")).alias("card"))


@query("rolling_origin_evaluation")
def q_rolling_origin_evaluation(spark, sf):
    return P.rounded(PMOD.rolling_origin_metrics(P.panel_clean(spark, sf), _split(spark, sf)))


@query("stream_hourly_avg_closed")
def q_stream_hourly_avg_closed(spark, sf):
    """Hourly averages whose windows the watermark has passed; a window is withheld until readings two hours behind its
    end have come."""
    out = STR.run_available(spark, STR.stream_hourly_avg(STR.read_readings_stream(spark, sf)), "closed")
    return P.rounded(out.drop("year", "month"))


@query("stream_append_resume")
def q_stream_append_resume(spark, sf):
    """Readings land in two parts; the query stops behind the first and goes on from its checkpoint with the second."""
    landed, lake = _scratch(spark, "landing"), _scratch(spark, "stream-lake")
    ev = SP.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    middle = F.lit(ev.agg(F.percentile_approx(F.col("ts").cast("timestamp").cast("long"), 0.5)).first()[0])
    for part in (F.col("ts").cast("timestamp").cast("long") < middle, F.col("ts").cast("timestamp").cast("long") >= middle):
        ev.filter(part).write.mode("append").parquet(landed)
        stream = STR.stream_hourly_avg(STR.read_readings_stream(spark, landed, "*.parquet"))
        STR.stream_append_batches(stream, f"{lake}/data", f"{lake}/checkpoint").awaitTermination()
    return P.rounded(spark.read.parquet(f"{lake}/data").drop("batch", "year", "month"))


from hourcast.session import materialize  # noqa: E402


# ---------------------------------------------------------------- runs in both forecast modes, and further reports
@query("metrics_union_modes")
def q_metrics_union_modes(spark, sf):
    """Ridge and least squares fitted in both forecast modes; with the weather of the target hour they differ."""
    keys = ["station_id", "mode", "horizon"]
    split = materialize(BM.split_by_mode(_features(spark, sf)), "split-by-mode")
    train, test = (split.filter(F.col("split") == s) for s in ("train", "test"))
    parts = []
    for name, kind, alpha in (("Ridge", "ridge", 1.0), ("LinearRegression", "ols", 0.0)):
        coefs = MOD.fit_linear(train, C.FEATURES, keys, kind, alpha)
        pred = MOD.predict_linear(test, coefs, C.FEATURES).select(*keys, "date", "y", "yhat", F.lit(name).alias("model"))
        parts.append(MET.regression_metrics(pred, (*keys, "model")))
    return SEL.metrics_union(*parts).select("mode", "station_id", "horizon", "model", "MAE", "RMSE", "R2", "n_test")


@query("missing_report_after")
def q_missing_report_after(spark, sf):
    """What is still missing in the cleaned series: nothing, where a column has any value."""
    return CL.missing_report(_clean(spark, sf), MEAS)


@query("daily_trend_thresholds")
def q_daily_trend_thresholds(spark, sf):
    """The daily trend with the published threshold lines and the days above them."""
    return ED.with_thresholds(P.rounded(ED.daily_trend(SP.daily_series(spark, sf))))


@query("backtest_seasons")
def q_backtest_seasons(spark, sf):
    return P.rounded(BT.backtest_by_season(_preds(spark, sf)))


@query("leaderboards_markdown")
def q_leaderboards_markdown(spark, sf):
    """The combined leaderboard written as a Markdown table and read back, a row per line."""
    path = _scratch(spark, "leaderboard-md")
    FL.write_markdown(SEL.combined_leaderboard(_selection(spark, sf)), path, ["station_id", "horizon", "group", "model", "MAE"], ["station_id", "horizon", "position"])
    return spark.read.text(path).filter("value like '| %'").select(F.col("value").alias("line"))

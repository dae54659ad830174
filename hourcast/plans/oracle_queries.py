"""Oracle SQL per registered query name."""
from __future__ import annotations

from hourcast import config as C
from hourcast.plans import oracle as O

SQL: dict = {}


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sel_r6(cols_double, cols_other, src):
    parts = list(cols_other) + [f"{O.r6(c)} AS {c}" for c in cols_double]
    return f"SELECT {', '.join(parts)} FROM {src}"


FEAT_DOUBLES = [c for c in O.F6_ORDER if c not in ("date",) and not c.endswith("_missing_flag")
                and c not in ("hour", "day_of_week", "month", "day_of_year", "year", "is_weekend", "is_winter",
                              "is_summer", "season")]
FEAT_OTHER = ["station_id", "date"] + O.FLAGS + ["hour", "day_of_week", "month", "day_of_year", "year",
                                                 "is_weekend", "is_winter", "is_summer", "season"]

SQL["hourly_grid"] = with_(O.AQ, O.WEATHER, O.grid(trim=False)) + sel_r6(
    C.MEASURES, ["station_id", "datetime"], "grid")
SQL["clean_series"] = with_(O.panel_clean()) + sel_r6(C.MEASURES, ["station_id", "datetime"] + O.FLAGS, "clean")
SQL["build_features"] = with_(O.panel_clean(), O.features()) + sel_r6(FEAT_DOUBLES, FEAT_OTHER, "feat")

# ---------------------------------------------------------------- prep / split
BASE = [O.panel_clean(), O.features(), O.valid_all(), O.split()]
SQL["valid_rows"] = with_(*BASE[:3]) + f"SELECT station_id, horizon, date, {O.r6('y')} AS y FROM valid"
SQL["chrono_split"] = with_(*BASE) + f"SELECT station_id, horizon, date, idx, n, split, {O.r6('y')} AS y FROM split"
_PRED = f"SELECT station_id, horizon, model, date, {O.r6('y')} AS y, {O.r6('yhat')} AS yhat FROM preds"
SQL["persistence"] = with_(*BASE, O.baselines(only="Persistence")) + _PRED
SQL["seasonal_naive"] = (with_(*BASE, O.baselines(only="SeasonalNaive_24h", name="p1"),
                               O.baselines(only="SeasonalNaive_168h", name="p2"),
                               "preds AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2)") + _PRED)
SQL["rolling_mean_baseline"] = (with_(*BASE, O.baselines(only="RollingMean_24h", name="p1"),
                                      O.baselines(only="RollingMean_168h", name="p2"),
                                      "preds AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2)") + _PRED)
SQL["persistence_metrics"] = with_(*BASE, O.baselines(only="Persistence"), O.metrics()) + "SELECT * FROM met"
SQL["regression_metrics"] = with_(*BASE, O.baselines(), O.metrics()) + "SELECT * FROM met"
_SEL = [*BASE, O.baselines(), O.metrics(), O.meta(), O.selection()]
SQL["rank_models"] = with_(*_SEL) + "SELECT station_id, mode, horizon, model, MAE, rank_mae FROM sel"
SQL["select_champion"] = (with_(*_SEL) +
                          "SELECT station_id, mode, horizon, model, MAE, rank_mae, selected_champion FROM sel")

# ---------------------------------------------------------------- cleaning ops
MEAS = C.MEASURES
_R6M = ", ".join(f"{O.r6(c)} AS {c}" for c in MEAS)
SQL["dedupe_hourly"] = with_(O.READINGS) + f"""SELECT station_id, datetime, seq, {O.r6('pm2_5')} AS pm2_5, {O.r6('pm10')} AS pm10
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, datetime ORDER BY seq) AS rn FROM readings) WHERE rn = 1"""
SQL["merge_outer"] = with_(O.AQ, O.WEATHER, """keys AS (
  SELECT station_id, datetime FROM aq
  UNION SELECT st.station_id, w.datetime FROM (SELECT DISTINCT station_id FROM aq) st, weather w)""") + f"""
SELECT k.station_id, k.datetime, {', '.join(O.r6(('aq.' if c in C.AQ_COLUMNS else 'w.') + c) + ' AS ' + c for c in MEAS)}
FROM keys k LEFT JOIN aq ON aq.station_id = k.station_id AND aq.datetime = k.datetime
LEFT JOIN weather w ON w.datetime = k.datetime"""
SQL["drop_partition_cols"] = with_(O.AQ) + f"SELECT station_id, datetime, {O.r6('pm2_5')} AS pm2_5, {O.r6('pm10')} AS pm10 FROM aq"
SQL["detect_time_column"] = with_(O.WEATHER) + "SELECT datetime, " + ", ".join(
    f"{O.r6(c)} AS {c}" for c in C.WEATHER_COLUMNS) + " FROM weather"
SQL["trim_leading_missing"] = with_(O.AQ, O.WEATHER, O.grid(trim=False)) + f"""SELECT station_id, datetime, {_R6M}
FROM (SELECT *, min(CASE WHEN pm2_5 IS NOT NULL THEN pos END) OVER (PARTITION BY station_id) AS f FROM grid)
WHERE f IS NULL OR pos >= f"""
_NULLED = [O.AQ, O.WEATHER, O.grid(True), O.nulled()]
SQL["null_outliers"] = with_(*_NULLED) + f"SELECT station_id, datetime, {_R6M} FROM nulled"
SQL["missing_flags"] = with_(*_NULLED, O.flagged()) + f"SELECT station_id, datetime, {', '.join(O.FLAGS)} FROM flagged"


def _nv_cols(src):
    back = f"OVER ({O.W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"OVER ({O.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    nv = []
    for c in MEAS:
        nv += [f"max(CASE WHEN {c} IS NOT NULL THEN pos END) {back} AS pp_{c}",
               f"last_value({c} IGNORE NULLS) {back} AS pv_{c}",
               f"min(CASE WHEN {c} IS NOT NULL THEN pos END) {fwd} AS np_{c}",
               f"first_value({c} IGNORE NULLS) {fwd} AS nv_{c}"]
    return f"nvx AS (SELECT *, {', '.join(nv)} FROM {src})"


_interp = ", ".join(O.r6(f"""CASE WHEN {c} IS NOT NULL THEN {c}
  WHEN pp_{c} IS NOT NULL AND pos - pp_{c} <= 3 THEN
    coalesce((nv_{c} - pv_{c}) / CAST(np_{c} - pp_{c} AS DOUBLE) * CAST(pos - pp_{c} AS DOUBLE) + pv_{c}, pv_{c}) END""")
                   + f" AS {c}" for c in MEAS)
SQL["interpolate_capped"] = with_(*_NULLED, _nv_cols("nulled")) + f"SELECT station_id, datetime, {_interp} FROM nvx"
SQL["forward_fill"] = with_(*_NULLED, _nv_cols("nulled")) + "SELECT station_id, datetime, " + ", ".join(
    O.r6(f"coalesce({c}, pv_{c})") + f" AS {c}" for c in MEAS) + " FROM nvx"
SQL["leading_fill"] = with_(*_NULLED, _nv_cols("nulled")) + "SELECT station_id, datetime, " + ", ".join(
    O.r6(f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0.0)")
    + f" AS {c}" for c in MEAS) + " FROM nulled"
_stack = " UNION ALL ".join(
    f"SELECT station_id, n_rows, '{c}' AS column_name, {c} AS n_missing FROM mr" for c in MEAS)
SQL["missing_report"] = with_(O.AQ, O.WEATHER, O.grid(True), "mr AS (SELECT station_id, count(*) AS n_rows, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in MEAS) + " FROM grid GROUP BY 1)") + \
    f"SELECT station_id, n_rows, column_name, n_missing, {O.r6('n_missing * 100.0 / n_rows')} AS pct_missing FROM ({_stack})"

# ---------------------------------------------------------------- feature ops
_CLEAN = [O.panel_clean(), O.features(name="feat")]
SQL["calendar_features"] = with_(*_CLEAN) + "SELECT station_id, datetime, hour, day_of_week, month, day_of_year, year FROM feat_all"
SQL["season_flags"] = with_(*_CLEAN) + "SELECT station_id, datetime, is_weekend, is_winter, is_summer, season FROM feat_all"


def _fsel(cols):
    return "SELECT station_id, datetime, " + ", ".join(f"{O.r6(c)} AS {c}" for c in cols) + " FROM feat_all"


SQL["cyclical_features"] = with_(*_CLEAN) + _fsel(["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"])
SQL["lag_features"] = with_(*_CLEAN) + _fsel([f"pm2_5_lag_{k}" for k in C.LAGS])
SQL["rolling_features"] = with_(*_CLEAN) + _fsel([f"pm2_5_roll{n}_mean" for n in C.ROLL_MEANS] + ["pm2_5_roll24_std", "pm2_5_roll24_max"])
SQL["trend_features"] = with_(*_CLEAN) + _fsel(["pm2_5_diff_1h", "pm2_5_diff_24h"])
SQL["ratio_features"] = with_(*_CLEAN) + _fsel(["pm25_pm10_ratio"])
SQL["horizon_targets"] = with_(*_CLEAN) + _fsel([f"target_pm2_5_t{h}" for h in C.HORIZONS])
SQL["target_coverage"] = with_(*_CLEAN) + " UNION ALL ".join(
    f"SELECT station_id, {h} AS horizon, count(target_pm2_5_t{h}) AS n_valid FROM feat_all GROUP BY 1" for h in C.HORIZONS)
SQL["drop_incomplete_inference"] = with_(*_CLEAN) + "SELECT station_id, date FROM feat"
SQL["drop_incomplete_training"] = with_(O.panel_clean(), O.features(is_inference=False)) + "SELECT station_id, date FROM feat"
SQL["window_matrix"] = with_(*BASE) + f"""SELECT station_id, date, split, {O.r6('l1')} AS lag_1, {O.r6('l168')} AS lag_168,
  {O.r6('ws')} AS window_sum FROM (
  SELECT *, lag(y, 0) OVER w AS y0, lag(pm2_5, 1) OVER w AS l1, lag(pm2_5, 168) OVER w AS l168,
         sum(pm2_5) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS ws,
         count(*) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS wn
  FROM split WHERE horizon = 24 WINDOW w AS (PARTITION BY station_id ORDER BY pos))
WHERE wn = 168 AND split IN ('train', 'test')"""
SQL["window_matrix_all"] = with_(*BASE) + f"""SELECT station_id, horizon, date, split, {O.r6('l1')} AS lag_1, {O.r6('l168')} AS lag_168,
  {O.r6('ws')} AS window_sum FROM (
  SELECT *, lag(pm2_5, 1) OVER w AS l1, lag(pm2_5, 168) OVER w AS l168,
         sum(pm2_5) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS ws,
         count(*) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS wn
  FROM split WINDOW w AS (PARTITION BY station_id, horizon ORDER BY pos))
WHERE wn = 168 AND split IN ('train', 'test')"""

# ---------------------------------------------------------------- AQI and scalar functions
_EV = "ev AS (SELECT event_id, value FROM events)"
_EVA = [_EV, O.with_aqi("ev", {"v": "value"}, "eva")]
SQL["pm25_to_aqi"] = with_(*_EVA) + "SELECT event_id, value, aqi_v AS aqi FROM eva"
SQL["aqi_to_level"] = with_(*_EVA) + f"SELECT event_id, aqi_v AS aqi, lvl_v AS label, {O.color_of('aqi_v')} AS color FROM eva"
_IDX = "CASE WHEN aqi_v IS NULL THEN NULL ELSE " + " + ".join(
    f"CAST(aqi_v > {u} AS INTEGER)" for u, _l, _c in C.AQI_LEVELS[:-1]) + " END"
_DIM = "dim(level_idx, label_us, label_vn, color_lower, aqi_low, aqi_high) AS (VALUES " + ", ".join(
    f"({i}, '{C.AQI_LEVELS_US[i]}', '{C.AQI_LEVELS_VN[i]}', '{C.AQI_COLORS[i]}', {C.AQI_BREAKPOINTS[i]}, {C.AQI_BREAKPOINTS[i + 1]})"
    for i in range(len(C.AQI_LEVELS))) + ")"
SQL["aqi_labels"] = with_(*_EVA, _DIM) + f"""SELECT e.event_id, e.level_idx, d.label_us, d.label_vn, d.color_lower, d.aqi_low, d.aqi_high
FROM (SELECT event_id, {_IDX} AS level_idx FROM eva) e LEFT JOIN dim d USING (level_idx)"""
_ADV = "adv(label, advice) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in C.AQI_ADVICE.items()) + ")"
SQL["aqi_advice"] = with_(*_EVA, _ADV) + f"""SELECT e.event_id, e.lvl_v AS label, coalesce(a.advice, '{C.AQI_ADVICE_DEFAULT}') AS advice
FROM eva e LEFT JOIN adv a ON a.label = e.lvl_v"""
SQL["is_unhealthy"] = with_(*_EVA) + f"SELECT event_id, lvl_v IN {O.UNHEALTHY_SQL} AS is_unhealthy FROM eva"
SQL["safe_model_name"] = """SELECT p_partkey, replace(replace(replace(replace(lower(concat(p_name, ' (v1/', p_brand, ')')),
  ' ', '_'), '/', '_'), '(', ''), ')', '') AS safe_name FROM part"""
SQL["parse_horizons"] = """SELECT o_orderkey, array_to_string(list_transform(list_filter(list_transform(string_split(
  concat_ws(',', CAST(o_custkey % 100 AS VARCHAR), ' ', CAST(o_orderkey % 72 AS VARCHAR)), ','), lambda x: trim(x)),
  lambda x: x <> ''), lambda x: CAST(x AS INTEGER)), '|') AS horizons FROM orders"""

# ---------------------------------------------------------------- prep
_FEAT = [O.panel_clean(), O.features()]
SQL["oracle_weather_shift"] = with_(*_FEAT) + "SELECT station_id, date, " + ", ".join(
    O.r6(f"lead({c}, 24) OVER (PARTITION BY station_id ORDER BY pos)") + f" AS {c}" for c in C.WEATHER_COLUMNS) + " FROM feat"
SQL["time_series_folds"] = with_(*BASE, """tv AS (
  SELECT station_id, date, row_number() OVER (PARTITION BY station_id ORDER BY pos) - 1 AS i,
         count(*) OVER (PARTITION BY station_id) AS m
  FROM split WHERE horizon = 24 AND split IN ('train', 'valid'))""") + """SELECT station_id, date, fold, role FROM (
  SELECT station_id, date, fold,
         CASE WHEN i < m - floor(m / 6) * 5 + (fold - 1) * floor(m / 6) THEN 'train'
              WHEN i < m - floor(m / 6) * 5 + fold * floor(m / 6) THEN 'test' END AS role, floor(m / 6) AS ts
  FROM tv, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold))
WHERE role IS NOT NULL AND ts > 0"""
SQL["oracle_weather_shift_all"] = with_(*_FEAT) + " UNION ALL ".join(f"SELECT station_id, {h} AS horizon, date, " + ", ".join(
    O.r6(f"lead({c}, {h}) OVER (PARTITION BY station_id ORDER BY pos)") + f" AS {c}" for c in C.WEATHER_COLUMNS) + " FROM feat" for h in C.HORIZONS)
SQL["time_series_folds_all"] = with_(*BASE, """tv AS (
  SELECT station_id, horizon, date, row_number() OVER (PARTITION BY station_id, horizon ORDER BY pos) - 1 AS i,
         count(*) OVER (PARTITION BY station_id, horizon) AS m
  FROM split WHERE split IN ('train', 'valid'))""") + """SELECT station_id, horizon, date, fold, role FROM (
  SELECT station_id, horizon, date, fold,
         CASE WHEN i < m - floor(m / 6) * 5 + (fold - 1) * floor(m / 6) THEN 'train'
              WHEN i < m - floor(m / 6) * 5 + fold * floor(m / 6) THEN 'test' END AS role, floor(m / 6) AS ts
  FROM tv, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold))
WHERE role IS NOT NULL AND ts > 0"""
SQL["rolling_origin_windows"] = with_(*_FEAT, """ro AS (
  SELECT station_id, date, pm2_5, row_number() OVER (PARTITION BY station_id ORDER BY pos) - 1 AS i,
         count(*) OVER (PARTITION BY station_id) AS m FROM feat),
ro2 AS (SELECT *, m - floor(m * 0.8::DOUBLE) AS holdout,
               m - least(6, greatest(1, floor((m - floor(m * 0.8::DOUBLE)) / 72))) * 72 AS ts0 FROM ro),
ro3 AS (SELECT *, CAST(floor((i - ts0) / 72) AS INTEGER) AS "window" FROM ro2)""") + f"""SELECT station_id, date, "window",
  CAST(ts0 + "window" * 72 - 1 AS BIGINT) AS cutoff_idx, CAST(i - (ts0 + "window" * 72 - 1) AS INTEGER) AS forecast_horizon,
  {O.r6('pm2_5')} AS pm2_5
FROM ro3 WHERE i >= ts0 AND holdout >= 72 AND (i - (ts0 + "window" * 72 - 1)) IN (1, 24, 48, 72)"""
SQL["train_valid_union"] = with_(*BASE) + "SELECT station_id, horizon, date, split FROM split WHERE split IN ('train', 'valid')"

# ---------------------------------------------------------------- legacy baselines, metrics, selection


def _legacy_sql(period, name):
    lag = "CASE horizon " + " ".join(f"WHEN {h} THEN lag(y, {h}) OVER w" for h in C.HORIZONS) + " END" \
        if period is None else f"lag(y, {period}) OVER w"
    return with_(*BASE, f"""lg AS (
  SELECT s.*, CASE WHEN split = 'test' THEN idx - nv ELSE idx END AS p2
  FROM split s JOIN (SELECT station_id, horizon, count(*) FILTER (WHERE split = 'valid') AS nv FROM split GROUP BY 1, 2)
       USING (station_id, horizon) WHERE split IN ('train', 'test')),
lg2 AS (SELECT *, {lag} AS p FROM lg WINDOW w AS (PARTITION BY station_id, horizon ORDER BY p2)),
tm AS (SELECT station_id, horizon, avg(CASE WHEN split = 'train' THEN y END) AS tm FROM split GROUP BY 1, 2)""") + f"""
SELECT station_id, horizon, '{name}' AS model, date, {O.r6('y')} AS y, {O.r6('coalesce(p, tm)')} AS yhat
FROM lg2 JOIN tm USING (station_id, horizon) WHERE split = 'test'"""


SQL["naive_legacy"] = _legacy_sql(None, "NaivePersistence")
SQL["seasonal_naive_legacy"] = _legacy_sql(168, "SeasonalNaive(168h)")
_P = [*BASE, O.baselines()]
SQL["mae_rmse_r2"] = with_(*_P) + f"""SELECT station_id, horizon, model, {O.rnd('avg(abs(yhat - y))', 2)} AS MAE,
  {O.rnd('sqrt(avg((yhat - y) * (yhat - y)))', 2)} AS RMSE,
  {O.rnd('CASE WHEN var_pop(y) * count(y) = 0 THEN CASE WHEN sum((yhat - y) * (yhat - y)) = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(y)) END', 4)} AS R2
FROM preds GROUP BY 1, 2, 3"""
_PL = [*_P, "pm AS (SELECT * FROM preds WHERE y IS NOT NULL AND yhat IS NOT NULL AND NOT isnan(y) AND NOT isnan(yhat))",
       O.with_aqi("pm", {"t": "y", "p": "yhat"}, "pl")]
_LABELS = [lv[1] for lv in C.AQI_LEVELS]
SQL["aqi_confusion"] = with_(*_PL) + " UNION ALL ".join(
    f"SELECT station_id, horizon, model, {i} AS true_idx, '{t}' AS true_level, " + ", ".join(
        f"count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p = '{p}') AS pred_{j}" for j, p in enumerate(_LABELS))
    + " FROM pl GROUP BY 1, 2, 3" for i, t in enumerate(_LABELS))
SQL["aqi_accuracy"] = with_(*_PL) + f"SELECT station_id, horizon, model, {O.rnd('avg(CAST(lvl_t = lvl_p AS DOUBLE))', 6)} AS accuracy FROM pl GROUP BY 1, 2, 3"
_F1 = " + ".join(
    f"(CASE WHEN 2 * count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p = '{t}') + count(*) FILTER (WHERE lvl_t <> '{t}' AND lvl_p = '{t}') + count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p <> '{t}') > 0 "
    f"THEN 2 * count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p = '{t}') / (2 * count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p = '{t}') + count(*) FILTER (WHERE lvl_t <> '{t}' AND lvl_p = '{t}') + count(*) FILTER (WHERE lvl_t = '{t}' AND lvl_p <> '{t}')) ELSE 0.0 END)"
    for t in _LABELS)
SQL["f1_macro"] = with_(*_PL) + f"SELECT station_id, horizon, model, {O.rnd('(' + _F1 + ') / 6.0', 6)} AS f1_macro FROM pl GROUP BY 1, 2, 3"
SQL["recall_unhealthy"] = with_(*_PL) + f"""SELECT station_id, horizon, model,
  {O.rnd(f"CASE WHEN count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL}) > 0 THEN count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL} AND lvl_p IN {O.UNHEALTHY_SQL}) / count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL}) ELSE 0.0 END", 6)} AS recall_unhealthy
FROM pl GROUP BY 1, 2, 3"""
_SELQ = with_(*_SEL)
_DEPL = "(" + ", ".join(f"'{g}'" for g in C.DEPLOYABLE_GROUPS) + ")"
SQL["deployable_champion"] = _SELQ + f"""SELECT c.station_id, c.mode, c.horizon, c.model AS champion, c."group" AS champion_group,
  CASE WHEN c."group" IN {_DEPL} THEN c.model ELSE b.model END AS deployable_model
FROM (SELECT * FROM sel WHERE mode = 'operational' AND selected_champion) c
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, mode, horizon
                 ORDER BY rank_mae NULLS LAST, complexity_rank, runtime_seconds, spec_order) AS rn
           FROM sel WHERE mode = 'operational' AND status = 'ok' AND MAE IS NOT NULL AND "group" IN {_DEPL}) WHERE rn = 1) b
ON b.station_id = c.station_id AND b.mode = c.mode AND b.horizon = c.horizon"""
_SC = 'station_id, mode, horizon, model, "group", MAE, rank_mae, selected_champion'
SQL["leaderboard"] = _SELQ + f"SELECT {_SC} FROM sel WHERE status = 'ok' AND selected_champion"
SQL["final_leaderboard"] = _SELQ + f"SELECT {_SC} FROM sel WHERE status = 'ok' AND selected_champion AND mode = 'operational'"
_GO = "CASE \"group\" " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.GROUP_ORDER.items()) + f" ELSE {C.UNKNOWN_GROUP_ORDER} END"
SQL["combined_leaderboard"] = _SELQ + f"""SELECT station_id, horizon, model, "group", coalesce(tuned, false) AS tuned, MAE, group_order,
  CAST(row_number() OVER (PARTITION BY station_id, horizon ORDER BY group_order, MAE, model) AS INTEGER) AS position
FROM (SELECT *, {_GO} AS group_order FROM sel WHERE status = 'ok' AND mode = 'operational')"""
SQL["compare_models"] = _SELQ + """SELECT station_id, horizon, model, MAE,
  CAST(floor(rank() OVER (PARTITION BY station_id, horizon ORDER BY MAE) + (count(*) OVER (PARTITION BY station_id, horizon, MAE) - 1) / 2.0) AS INTEGER) AS avg_rank
FROM meta"""
SQL["metrics_union"] = with_(*BASE, O.baselines(), O.metrics()) + """SELECT 'operational' AS mode, station_id, horizon, model, MAE, RMSE, R2, n_test FROM met
UNION ALL SELECT 'oracle_weather' AS mode, station_id, horizon, model, MAE, RMSE, R2, n_test FROM met"""
_SKIPPED = "(VALUES " + ", ".join("('" + m + "', '" + r.replace("'", "''") + "')" for m, r in C.SKIPPED_MODELS) + ") AS s(model, reason)"
SQL["skip_report"] = with_(*BASE) + f"""SELECT station_id, s.model, 'skipped' AS status, s.reason
FROM (SELECT DISTINCT station_id FROM split) st, {_SKIPPED}"""

# ---------------------------------------------------------------- backtests
SQL["backtest_k1_k3"] = with_(*_PL) + f"""SELECT station_id, model, horizon, {O.r6('avg(abs(yhat - y))')} AS mae,
  {O.r6('sqrt(avg((yhat - y) * (yhat - y)))')} AS rmse, {O.r6(O.rnd('(' + _F1 + ') / 6.0', 6))} AS f1_macro,
  CASE WHEN horizon = 1 THEN 'K1' WHEN horizon = 24 THEN 'K2' ELSE 'K3' END AS scenario
FROM pl WHERE horizon IN (1, 24, 72) GROUP BY station_id, model, horizon"""
SQL["backtest_k4"] = with_(*_P, "thr AS (SELECT station_id, model, quantile_cont(y, 0.95) AS threshold_95 FROM preds WHERE horizon = 24 AND y IS NOT NULL GROUP BY 1, 2)",
                           "k4 AS (SELECT p.*, t.threshold_95 FROM preds p JOIN thr t USING (station_id, model) WHERE p.horizon = 24 AND p.y IS NOT NULL AND p.yhat IS NOT NULL AND p.y >= t.threshold_95)",
                           O.with_aqi("k4", {"t": "y", "p": "yhat"}, "k4l")) + f"""SELECT t.station_id, t.model, {O.r6('t.threshold_95')} AS threshold_95,
  {O.r6('a.mae')} AS mae, {O.r6('a.rmse')} AS rmse, {O.r6('a.recall_unhealthy')} AS recall_unhealthy
FROM thr t LEFT JOIN (SELECT station_id, model, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
  CASE WHEN count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL}) > 0 THEN count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL} AND lvl_p IN {O.UNHEALTHY_SQL}) / count(*) FILTER (WHERE lvl_t IN {O.UNHEALTHY_SQL}) ELSE 0.0 END AS recall_unhealthy
  FROM k4l GROUP BY 1, 2) a USING (station_id, model)"""
SQL["backtest_k5"] = with_(*_P) + f"""SELECT station_id, model,
  {O.r6('avg(abs(yhat - y)) FILTER (WHERE month(date) IN (12, 1, 2))')} AS mae_winter,
  {O.r6('avg(abs(yhat - y)) FILTER (WHERE month(date) IN (6, 7, 8))')} AS mae_summer,
  count(*) FILTER (WHERE month(date) IN (12, 1, 2)) AS count_winter, count(*) FILTER (WHERE month(date) IN (6, 7, 8)) AS count_summer
FROM preds WHERE horizon = 24 AND y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2"""

# ---------------------------------------------------------------- EDA
SQL["daily_trend"] = with_(O.DAILY, """dd AS (SELECT station_id, CAST(datetime AS DATE) AS day, avg(pm2_5) AS daily_mean FROM daily GROUP BY 1, 2),
db AS (SELECT station_id, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM dd GROUP BY 1),
ds AS (SELECT db.station_id, db.day, dd.daily_mean FROM db LEFT JOIN dd USING (station_id, day))""") + f"""SELECT station_id, day, {O.r6('daily_mean')} AS daily_mean,
  {O.r6('(' + ' + '.join(f'lag(daily_mean, {k}) OVER w' for k in range(6, -1, -1)) + ') / 7.0')} AS trend_7d,
  {O.r6('(' + ' + '.join(f'lag(daily_mean, {k}) OVER w' for k in range(29, -1, -1)) + ') / 30.0')} AS trend_30d
FROM ds WINDOW w AS (PARTITION BY station_id ORDER BY day)"""
_CL = [O.panel_clean()]
SQL["seasonal_decompose"] = with_(*_CL, """sd AS (
  SELECT station_id, datetime, pos, pm2_5 AS observed,
         CASE WHEN count(pm2_5) OVER (w ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
              THEN ((lag(pm2_5, 11) OVER w + lag(pm2_5, 10) OVER w + lag(pm2_5, 9) OVER w + lag(pm2_5, 8) OVER w + lag(pm2_5, 7) OVER w + lag(pm2_5, 6) OVER w + lag(pm2_5, 5) OVER w + lag(pm2_5, 4) OVER w + lag(pm2_5, 3) OVER w + lag(pm2_5, 2) OVER w + lag(pm2_5, 1) OVER w + pm2_5 + lead(pm2_5, 1) OVER w + lead(pm2_5, 2) OVER w + lead(pm2_5, 3) OVER w + lead(pm2_5, 4) OVER w + lead(pm2_5, 5) OVER w + lead(pm2_5, 6) OVER w + lead(pm2_5, 7) OVER w + lead(pm2_5, 8) OVER w + lead(pm2_5, 9) OVER w + lead(pm2_5, 10) OVER w + lead(pm2_5, 11) OVER w)
                    + 0.5 * (lag(pm2_5, 12) OVER w + lead(pm2_5, 12) OVER w)) / 24.0 END AS trend,
         CAST(pos % 24 AS INTEGER) AS phase
  FROM clean WINDOW w AS (PARTITION BY station_id ORDER BY pos)),
ph AS (SELECT station_id, phase, pm - avg(pm) OVER (PARTITION BY station_id) AS seasonal
       FROM (SELECT station_id, phase, avg(observed - trend) AS pm FROM sd GROUP BY 1, 2))""") + f"""SELECT s.station_id, s.datetime, {O.r6('s.observed')} AS observed,
  {O.r6('s.trend')} AS trend, s.phase, {O.r6('p.seasonal')} AS seasonal, {O.r6('s.observed - s.trend - p.seasonal')} AS resid
FROM sd s LEFT JOIN ph p USING (station_id, phase)"""


def _box(src_ctes, src, by_expr, by):
    return with_(*src_ctes, f"""bx AS (SELECT station_id, {by_expr} AS {by}, pm2_5 AS v FROM {src}),
bq AS (SELECT station_id, {by}, count(v) AS n, quantile_cont(v, [0.25, 0.5, 0.75]) AS q FROM bx GROUP BY 1, 2),
bq2 AS (SELECT station_id, {by}, n, q[1] AS q1, q[2] AS median, q[3] AS q3 FROM bq)""") + f"""SELECT b.station_id, b.{by}, b.n,
  {O.r6('b.q1')} AS q1, {O.r6('b.median')} AS median, {O.r6('b.q3')} AS q3,
  {O.r6('min(CASE WHEN x.v >= b.q1 - 1.5 * (b.q3 - b.q1) THEN x.v END)')} AS whisker_lo,
  {O.r6('max(CASE WHEN x.v <= b.q3 + 1.5 * (b.q3 - b.q1) THEN x.v END)')} AS whisker_hi,
  count(*) FILTER (WHERE x.v < b.q1 - 1.5 * (b.q3 - b.q1) OR x.v > b.q3 + 1.5 * (b.q3 - b.q1)) AS n_outliers
FROM bq2 b JOIN bx x USING (station_id, {by}) GROUP BY b.station_id, b.{by}, b.n, b.q1, b.median, b.q3"""


SQL["box_by_month"] = _box([O.DAILY], "daily", "CAST(month(datetime) AS INTEGER)", "month")
SQL["box_by_hour"] = _box(_CL, "clean", "CAST(hour(datetime) AS INTEGER)", "hour")
SQL["hour_dow_pivot"] = with_(*_CL) + "SELECT station_id, CAST(hour(datetime) AS INTEGER) AS hour, " + ", ".join(
    O.r6(f"avg(CASE WHEN isodow(datetime) - 1 = {i} THEN pm2_5 END)") + f" AS dow_{i}" for i in range(7)) + " FROM clean GROUP BY 1, 2"
_ACF_K = range(C.ACF_MAX_LAG + 1)
SQL["acf"] = with_(*_CL, """ad AS (SELECT c.station_id, c.pos, c.pm2_5 - m.m AS d FROM clean c JOIN (SELECT station_id, avg(pm2_5) AS m FROM clean GROUP BY 1) m USING (station_id))""",
                   "ap AS (SELECT station_id, " + ", ".join(f"d * lag(d, {k}) OVER w AS p{k}" for k in _ACF_K) + " FROM ad WINDOW w AS (PARTITION BY station_id ORDER BY pos))",
                   "asum AS (SELECT station_id, " + ", ".join(f"sum(p{k}) AS s{k}" for k in _ACF_K) + " FROM ap GROUP BY 1)") + \
    f"SELECT station_id, unnest([{', '.join(str(k) for k in _ACF_K)}]::INTEGER[]) AS lag, " + \
    f"unnest([{', '.join(O.r6(f's{k} / s0') for k in _ACF_K)}]) AS acf FROM asum"
_SP_COLS = ["pm2_5", "pm10", "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "pressure_msl"]
_PAIRS = [(a, b) for i, a in enumerate(_SP_COLS) for j, b in enumerate(_SP_COLS) if j <= i]
SQL["spearman_matrix"] = with_(*_CL, "rk AS (SELECT station_id, " + ", ".join(
    f"rank() OVER (PARTITION BY station_id ORDER BY {c}) + (count(*) OVER (PARTITION BY station_id, {c}) - 1) / 2.0 AS r_{c}"
    for c in _SP_COLS) + " FROM clean)") + " UNION ALL ".join(
    f"SELECT station_id, '{a}' AS col_a, '{b}' AS col_b, {O.r6(f'corr(r_{a}, r_{b})')} AS rho FROM rk GROUP BY 1" for a, b in _PAIRS)
SQL["missing_by_month"] = with_(*_CL) + "SELECT station_id, strftime(datetime, '%Y-%m') AS month, " + ", ".join(
    O.r6(f"avg({c}_missing_flag) * 100") + f" AS {c}" for c in ("pm2_5", "pm10", "temperature_2m")) + " FROM clean GROUP BY 1, 2"
SQL["pred_vs_actual_tail"] = with_(*_P) + f"""SELECT station_id, horizon, model, date, {O.r6('y')} AS y, {O.r6('yhat')} AS yhat FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, horizon, model ORDER BY date DESC) AS rd FROM preds)
WHERE rd <= 200"""

# ---------------------------------------------------------------- serving
_LAST = """la AS (
  SELECT station_id, coalesce(arg_max(CASE WHEN pm2_5_missing_flag = 0 THEN {'d': date, 'v': pm2_5} END,
                                       CASE WHEN pm2_5_missing_flag = 0 THEN date END), arg_max({'d': date, 'v': pm2_5}, date)) AS r
  FROM feat GROUP BY 1),
la2 AS (SELECT station_id, r.d AS date, r.v AS pm2_5 FROM la)"""
_LA = [*_FEAT, _LAST, O.with_aqi("la2", {"a": "pm2_5"}, "la3")]
SQL["latest_actual"] = with_(*_LA) + f"SELECT station_id, date, {O.r6('pm2_5')} AS pm2_5, aqi_a AS aqi, lvl_a AS level, {O.color_of('aqi_a')} AS color FROM la3"
SQL["sensor_lag_hours"] = with_(*_FEAT, _LAST) + """SELECT station_id, date,
  greatest(0, CAST(trunc(date_diff('second', date, TIMESTAMP '2024-01-31 02:30:00') / 3600.0) AS BIGINT)) AS lag_hours FROM la2"""
SQL["aqi_delta_24h"] = with_(*_LA, """pv AS (SELECT station_id, pm2_5 FROM (SELECT station_id, pm2_5, row_number() OVER (PARTITION BY station_id ORDER BY date DESC) AS rd FROM feat) WHERE rd = 25)""", O.with_aqi("pv", {"b": "pm2_5"}, "pv2")) + """SELECT a.station_id, a.aqi_a AS aqi, p.aqi_b AS prev_aqi, a.aqi_a - p.aqi_b AS delta_aqi
FROM la3 a LEFT JOIN pv2 p USING (station_id)"""
SQL["nowcast_validation"] = with_(*_FEAT, """nm AS (SELECT * FROM (SELECT station_id, date, pm2_5, row_number() OVER (PARTITION BY station_id ORDER BY date DESC) AS rd
  FROM feat WHERE pm2_5_missing_flag = 0) WHERE rd <= 73),
nm2 AS (SELECT *, lag(pm2_5, 1) OVER (PARTITION BY station_id ORDER BY date) AS pred,
               row_number() OVER (PARTITION BY station_id ORDER BY date) AS rn FROM nm)""") + f"""SELECT station_id,
  {O.r6('avg(abs(pred - pm2_5))')} AS mae, count(*) AS n_hours FROM nm2 WHERE rn > 1 GROUP BY 1"""

# ---------------------------------------------------------------- state and sources
SQL["filter_time_range"] = with_(O.AQ) + f"""SELECT station_id, datetime, {O.r6('pm2_5')} AS pm2_5, {O.r6('pm10')} AS pm10 FROM aq
WHERE datetime > TIMESTAMP '2024-01-05 00:00:00' AND datetime <= least(TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-15 12:00:00')"""
SQL["plan_time_chunks"] = """WITH r AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
c AS (SELECT unnest(generate_series(s, e, INTERVAL 30 DAY)) AS chunk_start, e FROM r)
SELECT chunk_start, least(chunk_start + INTERVAL 30 DAY, e) AS chunk_end FROM c WHERE chunk_start < e"""
SQL["read_partitioned"] = with_(O.AQ) + f"""SELECT station_id, datetime, {O.r6('pm2_5')} AS pm2_5, {O.r6('pm10')} AS pm10,
  CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month FROM aq"""
SQL["read_features"] = with_(*_FEAT) + "SELECT station_id, date, " + ", ".join(
    f"{O.r6(c)} AS {c}" for c in ("pm2_5", "pm2_5_lag_24", "target_pm2_5_t24")) + " FROM feat"
SQL["high_watermark"] = with_(O.AQ) + """SELECT s.station_id, coalesce(a.mx, TIMESTAMP '2024-01-01 00:00:00') AS last_data_time
FROM (SELECT DISTINCT event_type AS station_id FROM events) s
LEFT JOIN (SELECT station_id, max(datetime) AS mx FROM aq WHERE datetime < TIMESTAMP '2024-01-10 00:00:00' AND station_id <> 'click' GROUP BY 1) a USING (station_id)"""
SQL["advance_watermark"] = with_(O.AQ, O.WEATHER) + """SELECT s.station_id, least(a.mx, (SELECT max(datetime) FROM weather WHERE datetime < TIMESTAMP '2024-01-20 00:00:00')) AS last_data_time
FROM (SELECT DISTINCT station_id FROM aq) s
LEFT JOIN (SELECT station_id, max(datetime) AS mx FROM aq WHERE station_id <> 'click' AND (station_id <> 'error' OR datetime < TIMESTAMP '2024-01-15 00:00:00') GROUP BY 1) a USING (station_id)"""
SQL["high_watermark_all"] = with_(O.AQ) + """SELECT s.station_id, coalesce(a.mx, TIMESTAMP '2024-01-01 00:00:00') AS last_data_time
FROM (SELECT DISTINCT event_type AS station_id FROM events) s
LEFT JOIN (SELECT station_id, max(datetime) AS mx FROM aq GROUP BY 1) a USING (station_id)"""
SQL["advance_watermark_all"] = with_(O.AQ, O.WEATHER) + """SELECT station_id, least(max(datetime), (SELECT max(datetime) FROM weather)) AS last_data_time
FROM aq GROUP BY 1"""
SQL["needs_rebuild"] = with_(*_FEAT) + """SELECT r.station_id, (f.mx IS NULL OR r.mx > f.mx) AS needs_rebuild
FROM (SELECT station_id, max(datetime) AS mx FROM aq GROUP BY 1) r LEFT JOIN (SELECT station_id, max(date) AS mx FROM feat GROUP BY 1) f USING (station_id)"""
SQL["staleness"] = with_(*_FEAT) + """SELECT station_id, max(date) AS feature_max,
  date_diff('second', max(date), CAST(t.as_of AS TIMESTAMP)) > 6 * 3600 AS is_stale, t.as_of
FROM feat, (VALUES ('2024-01-31 05:00:00'), ('2024-01-31 05:00:01')) AS t(as_of) GROUP BY station_id, t.as_of"""

# ---------------------------------------------------------------- sources with SQL form
SQL["append_partitioned"] = with_(O.AQ) + """SELECT CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month,
  count(*) AS n_rows FROM aq GROUP BY 1, 2"""
SQL["localize_time"] = "SELECT event_id, CAST(ts AS TIMESTAMP) + INTERVAL 7 HOUR AS datetime FROM events"
SQL["latest_feature_row"] = with_(*_FEAT, "lf AS (SELECT station_id, max(pos) AS lp FROM feat GROUP BY 1)") + f"""SELECT f.station_id, f.date,
  {O.r6('f.pm2_5')} AS pm2_5, {O.r6('f.pm2_5_lag_1')} AS pm2_5_lag_1, {O.r6('f.pm2_5_roll24_mean')} AS pm2_5_roll24_mean,
  {O.r6('f.pm2_5')} AS pm2_5_seq_lag_1,
  {O.r6('(SELECT g.pm2_5 FROM feat g WHERE g.station_id = f.station_id AND g.pos = l.lp - 23)')} AS pm2_5_seq_lag_24,
  {O.r6('(SELECT g.pm2_5 FROM feat g WHERE g.station_id = f.station_id AND g.pos = l.lp - 167)')} AS pm2_5_seq_lag_168
FROM feat f JOIN lf l ON l.station_id = f.station_id AND f.pos = l.lp"""
SQL["inject_future_weather"] = with_(*_FEAT, "lr AS (SELECT f.* FROM feat f JOIN (SELECT station_id, max(date) AS d FROM feat WHERE date <= TIMESTAMP '2024-01-29 00:00:00' GROUP BY 1) m ON m.station_id = f.station_id AND m.d = f.date)",
                                     "hz AS (SELECT CAST(unnest([1, 24, 48, 72]) AS INTEGER) AS horizon)") + \
    "SELECT lr.station_id, lr.date, hz.horizon, " + ", ".join(
        O.r6(f"coalesce(w.{c}, lr.{c})") + f" AS {c}" for c in C.WEATHER_COLUMNS) + \
    " FROM lr CROSS JOIN hz LEFT JOIN weather w ON w.datetime = lr.date + hz.horizon * INTERVAL 1 HOUR"
SQL["inject_future_weather_all"] = with_(*_FEAT, "hz AS (SELECT CAST(unnest([1, 24, 48, 72]) AS INTEGER) AS horizon)") + \
    "SELECT f.station_id, f.date, hz.horizon, " + ", ".join(
        O.r6(f"coalesce(w.{c}, f.{c})") + f" AS {c}" for c in C.WEATHER_COLUMNS) + \
    " FROM feat f CROSS JOIN hz LEFT JOIN weather w ON w.datetime = f.date + hz.horizon * INTERVAL 1 HOUR"
SQL["read_weather_json"] = SQL["detect_time_column"]
SQL["read_weather_forecast"] = SQL["detect_time_column"] + " WHERE datetime >= TIMESTAMP '2024-01-24 00:00:00'"
SQL["read_weather_forecast_all"] = SQL["detect_time_column"]
SQL["write_metrics_csv"] = _SELQ + "SELECT station_id, mode, horizon, model, MAE, RMSE, R2, rank_mae, selected_champion FROM sel"
SQL["write_runtime_csv"] = _SELQ + """SELECT station_id, mode, CAST(horizon AS INTEGER) AS horizon, model, "group", status FROM sel"""
SQL["read_aq_csv"] = f"""SELECT 'sensor' AS station_id, date_trunc('second', ts) + INTERVAL 7 HOUR AS datetime,
  {O.r6('value')} AS pm2_5, {O.r6('value * 2')} AS pm10 FROM events"""
SQL["write_features"] = with_(*_FEAT) + f"SELECT station_id, date, {O.r6('pm2_5')} AS pm2_5, {O.r6('target_pm2_5_t1')} AS target_pm2_5_t1 FROM feat"
SQL["write_leaderboards"] = _SELQ + "SELECT station_id, horizon, model, MAE FROM sel WHERE status = 'ok' AND selected_champion AND mode = 'operational'"
SQL["update_feature_state"] = with_(*_FEAT) + """SELECT r.station_id, TIMESTAMP '2024-02-01 00:00:00' AS generated_at,
  r.mx AS raw_data_max_time, f.mx AS feature_data_max_time, '1' AS feature_version
FROM (SELECT station_id, max(datetime) AS mx FROM aq GROUP BY 1) r
LEFT JOIN (SELECT station_id, max(date) AS mx FROM feat GROUP BY 1) f USING (station_id)"""
SQL["write_model_card"] = f"SELECT s.model, 'skipped' AS status, s.reason, 'operational' AS mode FROM {_SKIPPED}"
_MAN = _SELQ + """SELECT station_id, CAST(horizon AS INTEGER) AS horizon, model AS model_name,
  concat('models/champions/t', horizon, '_', replace(replace(replace(replace(lower(model), ' ', '_'), '/', '_'), '(', ''), ')', '')) AS artifact_path,
  'operational' AS forecast_mode, false AS uses_future_weather_forecast, 'pm2_5' AS target,
  MAE, RMSE, R2, recall_unhealthy_plus, mae_top5, 'lowest MAE; within 1%, simpler/faster wins' AS selection_rule
FROM sel WHERE selected_champion AND mode = 'operational'"""
SQL["write_manifest"] = _MAN
SQL["read_manifest"] = _MAN
SQL["champion_entry"] = f"SELECT * FROM ({_MAN}) WHERE horizon = 24"
SQL["stream_dedupe"] = f"SELECT event_type AS station_id, event_id, {O.r6('value')} AS value FROM events"

# windows that end two hours or more before the last reading: what the watermark has passed
_CLOSED = """SELECT event_type AS station_id, date_trunc('hour', ts)::TIMESTAMP AS datetime, round(avg(value) * 1000000) / 1000000 AS pm2_5, count(*) AS n
FROM events GROUP BY 1, 2 HAVING max(date_trunc('hour', ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)"""
SQL["stream_hourly_avg_closed"] = _CLOSED
SQL["stream_append_resume"] = _CLOSED
SQL["missing_report_after"] = with_(O.panel_clean(), "mr AS (SELECT station_id, count(*) AS n_rows, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in MEAS) + " FROM clean GROUP BY 1)") + \
    f"SELECT station_id, n_rows, column_name, n_missing, {O.r6('n_missing * 100.0 / n_rows')} AS pct_missing FROM ({_stack})"
SQL["daily_trend_thresholds"] = f"""SELECT *, 35.5::DOUBLE AS threshold_0, 55.5::DOUBLE AS threshold_1, daily_mean > 35.5::DOUBLE AS above_0, daily_mean > 55.5::DOUBLE AS above_1
FROM ({SQL["daily_trend"]})"""
SQL["backtest_seasons"] = with_(*_P) + f"""SELECT station_id, model, CASE WHEN month(date) IN (12, 1, 2) THEN 'DJF' WHEN month(date) IN (3, 4, 5) THEN 'MAM'
  WHEN month(date) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season, {O.r6('avg(abs(yhat - y))')} AS mae, count(*) AS n
FROM preds WHERE horizon = 24 AND y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2, 3"""

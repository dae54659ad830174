"""DuckDB oracle SQL for the registered queries.

Independent, plain-SQL statements of the same semantics (plain per-station
windows, no blocks) that DuckDB runs over the driver tables.  Shared steps are
CTE fragments composed per query.
"""
from __future__ import annotations

import math

from hourcast import config as C
from hourcast.operators.features import F6_ORDER, target_col

MEAS = C.MEASURES
FLAGS = [f"{c}_missing_flag" for c in MEAS]
W = "PARTITION BY station_id ORDER BY pos"


def r6(expr: str) -> str:
    """Round to 6 dp the same way in both engines: round(x * 1e6) / 1e6."""
    return f"(CASE WHEN round(({expr}) * 1000000.0) = 0 THEN 0.0::DOUBLE ELSE round(({expr}) * 1000000.0) / 1000000.0 END)"


def hour_pos(col: str) -> str:
    return f"date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', {col})"


# --------------------------------------------------------------------------
# panel
# --------------------------------------------------------------------------
AQ = """aq AS (
  SELECT event_type AS station_id, date_trunc('hour', ts) AS datetime,
         sum(CAST(round(value * 100) AS BIGINT)) / (100.0::DOUBLE * count(*)) AS pm2_5,
         max(value) AS pm10
  FROM events GROUP BY 1, 2)"""

WEATHER = """weather AS (
  SELECT datetime,
         sum(k) / (1.0::DOUBLE * count(*)) AS temperature_2m,
         CAST(max(k) AS DOUBLE) AS relative_humidity_2m,
         CAST(min(k) AS DOUBLE) AS wind_speed_10m,
         1000.0::DOUBLE + count(*) AS pressure_msl,
         sum(k % 7) / (1.0::DOUBLE * count(*)) AS precipitation
  FROM (SELECT event_id, date_trunc('hour', ts) AS datetime,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  GROUP BY 1)"""

READINGS = """readings AS (
  SELECT event_type AS station_id, date_trunc('hour', ts) AS datetime, event_id AS seq,
         value AS pm2_5, value AS pm10 FROM events)"""

DAILY = """daily AS (
  SELECT o_orderpriority AS station_id, CAST(o_orderdate AS TIMESTAMP) AS datetime,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (100.0::DOUBLE * count(*)) AS pm2_5,
         count(*) AS n_orders
  FROM orders GROUP BY 1, 2)"""


def grid(trim: bool = True) -> str:
    start = "coalesce(a.first_h, least(a.lo, w.lo))" if trim else "least(a.lo, w.lo)"
    return f"""bounds AS (
  SELECT a.station_id, {start} AS lo, greatest(a.hi, w.hi) AS hi
  FROM (SELECT station_id, min(datetime) AS lo, max(datetime) AS hi,
               min(CASE WHEN pm2_5 IS NOT NULL THEN datetime END) AS first_h FROM aq GROUP BY 1) a,
       (SELECT min(datetime) AS lo, max(datetime) AS hi FROM weather) w),
spine AS (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM bounds),
grid AS (
  SELECT s.station_id, s.datetime, {hour_pos('s.datetime')} AS pos, aq.pm2_5, aq.pm10,
         {', '.join('w.' + c for c in C.WEATHER_COLUMNS)}
  FROM spine s LEFT JOIN aq ON aq.station_id = s.station_id AND aq.datetime = s.datetime
               LEFT JOIN weather w ON w.datetime = s.datetime)"""


def nulled(src: str = "grid") -> str:
    cols = ", ".join(f"CASE WHEN {c} BETWEEN 0 AND 1000 THEN {c} END AS {c}" if c in C.POLLUTION_COLUMNS else c
                     for c in MEAS)
    return f"nulled AS (SELECT station_id, datetime, pos, {cols} FROM {src})"


def flagged(src: str = "nulled") -> str:
    fl = ", ".join(f"CAST({c} IS NULL AS TINYINT) AS {c}_missing_flag" for c in MEAS)
    return f"flagged AS (SELECT *, {fl} FROM {src})"


def filled(src: str = "flagged", limit: int = C.INTERPOLATION_LIMIT) -> str:
    back = f"OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    nv = []
    for c in MEAS:
        nv += [f"max(CASE WHEN {c} IS NOT NULL THEN pos END) {back} AS pp_{c}",
               f"last_value({c} IGNORE NULLS) {back} AS pv_{c}",
               f"min(CASE WHEN {c} IS NOT NULL THEN pos END) {fwd} AS np_{c}",
               f"first_value({c} IGNORE NULLS) {fwd} AS nv_{c}"]
    vals = []
    for c in MEAS:
        vals.append(f"""CASE WHEN {c} IS NOT NULL THEN {c}
      WHEN pp_{c} IS NOT NULL AND np_{c} IS NOT NULL
        THEN (nv_{c} - pv_{c}) / CAST(np_{c} - pp_{c} AS DOUBLE) * CAST(least(pos - pp_{c}, {limit}) AS DOUBLE) + pv_{c}
      WHEN pp_{c} IS NOT NULL THEN pv_{c} WHEN np_{c} IS NOT NULL THEN nv_{c} ELSE 0.0::DOUBLE END AS {c}""")
    return f"""nv AS (SELECT *, {', '.join(nv)} FROM {src}),
clean AS (SELECT station_id, datetime, pos, {', '.join(vals)}, {', '.join(FLAGS)} FROM nv)"""


def panel_clean() -> str:
    return ",\n".join([AQ, WEATHER, grid(True), nulled(), flagged(), filled()])


# --------------------------------------------------------------------------
# features
# --------------------------------------------------------------------------
def feature_exprs(horizons=C.HORIZONS) -> list[str]:
    tp = f"{2 * math.pi!r}"
    cal = ["CAST(hour(datetime) AS INTEGER) AS hour", "CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week",
           "CAST(month(datetime) AS INTEGER) AS month", "CAST(dayofyear(datetime) AS INTEGER) AS day_of_year",
           "CAST(year(datetime) AS INTEGER) AS year"]
    y = C.TARGET
    win = []
    for k in C.LAGS:
        win.append(f"lag({y}, {k}) OVER ({W}) AS {y}_lag_{k}")

    def full(n, agg, name):
        fr = f"OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        return f"CASE WHEN count({y}) {fr} = {n} THEN {agg}({y}) {fr} END AS {name}"

    for n in C.ROLL_MEANS:
        # explicit oldest-to-newest sum: the same addition order as a sliding frame in Spark
        chain = " + ".join(f"lag({y}, {k}) OVER ({W})" for k in range(n, 0, -1))
        win.append(f"({chain}) / {float(n)!r} AS {y}_roll{n}_mean")
    win.append(full(C.ROLL_STD, "stddev_samp", f"{y}_roll{C.ROLL_STD}_std"))
    win.append(full(C.ROLL_MAX, "max", f"{y}_roll{C.ROLL_MAX}_max"))
    win.append(f"{y} - lag({y}, 1) OVER ({W}) AS {y}_diff_1h")
    win.append(f"{y} - lag({y}, 24) OVER ({W}) AS {y}_diff_24h")
    win.append(f"{y} / (pm10 + {C.RATIO_EPS!r}) AS pm25_pm10_ratio")
    for h in horizons:
        win.append(f"lead({y}, {h}) OVER ({W}) AS {target_col(h)}")
    return cal, win, tp


def features(src: str = "clean", horizons=C.HORIZONS, is_inference: bool = True, name: str = "feat") -> str:
    cal, win, tp = feature_exprs(horizons)
    tcols = [target_col(h) for h in horizons]
    cyc = []
    for nm, srcc, per in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12)):
        cyc += [f"sin({tp} * {srcc} / {per}) AS {nm}_sin", f"cos({tp} * {srcc} / {per}) AS {nm}_cos"]
    flags = ["CAST(day_of_week >= 5 AS INTEGER) AS is_weekend",
             f"CAST(month IN ({', '.join(map(str, C.WINTER_MONTHS))}) AS INTEGER) AS is_winter",
             f"CAST(month IN ({', '.join(map(str, C.SUMMER_MONTHS))}) AS INTEGER) AS is_summer",
             "CAST(ceil(month / 3) AS INTEGER) AS season"]
    cols = [c for c in F6_ORDER if c != "date" and (not c.startswith("target_") or c in tcols)]
    feat_cols = [c for c in cols if c not in tcols]
    need = feat_cols + ([] if is_inference else [target_col(min(horizons))])
    where = " AND ".join(f"{c} IS NOT NULL" for c in need)
    return f"""{name}_cal AS (SELECT *, {', '.join(cal)} FROM {src}),
{name}_all AS (SELECT *, {', '.join(flags)}, {', '.join(cyc)}, {', '.join(win)} FROM {name}_cal),
{name} AS (SELECT station_id, datetime AS date, pos, {', '.join(cols)} FROM {name}_all WHERE {where})"""


# --------------------------------------------------------------------------
# AQI in SQL (same arithmetic as the column expressions)
# --------------------------------------------------------------------------
def d(v) -> str:
    return f"{float(v)!r}::DOUBLE"


def round1(x: str) -> str:
    a, b = f"(({x}) * 8.0::DOUBLE)", f"(({x}) * 2.0::DOUBLE)"
    s = f"({a} + {b})"
    e = f"({b} - ({s} - {a}))"
    fl = f"floor({s})"
    tie = f"({s} - {fl} = 0.5::DOUBLE)"
    return (f"((CASE WHEN {tie} AND {e} > 0 THEN {fl} + 1 WHEN {tie} AND {e} < 0 THEN {fl} "
            f"ELSE round_even({s}, 0) END) / 10.0::DOUBLE)")


def aqi_from_rounded(x: str, cr: str) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL", f"WHEN {cr} < 0 THEN 0"]
    for c_lo, c_hi, i_lo, i_hi in C.PM25_BREAKPOINTS:
        val = f"{d(i_hi - i_lo)} / {d(c_hi - c_lo)} * ({cr} - {d(c_lo)}) + {d(i_lo)}"
        parts.append(f"WHEN {cr} >= {d(c_lo)} AND {cr} <= {d(c_hi)} THEN CAST(round_even({val}, 0) AS INTEGER)")
    return "CASE " + " ".join(parts) + " ELSE 500 END"


def level_of(aqi: str) -> str:
    parts = [f"WHEN {aqi} IS NULL THEN NULL", f"WHEN {aqi} < 0 THEN '{C.AQI_LEVELS[0][1]}'"]
    for upper, label, _ in C.AQI_LEVELS:
        parts.append(f"WHEN {aqi} <= {upper} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{C.AQI_LEVELS[-1][1]}' END"


def color_of(aqi: str) -> str:
    parts = [f"WHEN {aqi} IS NULL THEN NULL", f"WHEN {aqi} < 0 THEN '{C.AQI_LEVELS[0][2]}'"]
    for upper, _, color in C.AQI_LEVELS:
        parts.append(f"WHEN {aqi} <= {upper} THEN '{color}'")
    return "CASE " + " ".join(parts) + f" ELSE '{C.AQI_LEVELS[-1][2]}' END"


def with_aqi(src: str, cols: dict, name: str) -> str:
    """CTEs adding aqi_<alias> and lvl_<alias> for {alias: column} over ``src``."""
    r = ", ".join(f"{round1(c)} AS _cr_{a}" for a, c in cols.items())
    q = ", ".join(f"{aqi_from_rounded(c, '_cr_' + a)} AS aqi_{a}" for a, c in cols.items())
    lv = ", ".join(f"{level_of('aqi_' + a)} AS lvl_{a}" for a in cols)
    return (f"{name}_r AS (SELECT *, {r} FROM {src}),\n{name}_q AS (SELECT *, {q} FROM {name}_r),\n"
            f"{name} AS (SELECT *, {lv} FROM {name}_q)")


UNHEALTHY_SQL = "(" + ", ".join(f"'{x}'" for x in C.UNHEALTHY_LEVELS) + ")"


def rnd(expr: str, digits: int) -> str:
    m = float(10 ** digits)
    return f"(CASE WHEN round(({expr}) * {m!r}) = 0 THEN 0.0::DOUBLE ELSE round(({expr}) * {m!r}) / {m!r} END)"


# --------------------------------------------------------------------------
# split, baselines and metrics
# --------------------------------------------------------------------------
def valid_all(src: str = "feat", horizons=C.HORIZONS) -> str:
    case = "CASE hz.horizon " + " ".join(f"WHEN {h} THEN {target_col(h)}" for h in horizons) + " END"
    vals = ", ".join(f"({h})" for h in horizons)
    return f"""valid0 AS (SELECT f.*, hz.horizon, {case} AS y FROM {src} f, (VALUES {vals}) hz(horizon)),
valid AS (SELECT * FROM valid0 WHERE y IS NOT NULL)"""


def split(src: str = "valid") -> str:
    return f"""split AS (
  SELECT *, CASE WHEN idx < floor(n * 0.7::DOUBLE) THEN 'train'
                 WHEN idx < floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id, horizon ORDER BY pos) - 1 AS idx,
               count(*) OVER (PARTITION BY station_id, horizon) AS n FROM {src}))"""


def baseline_specs_sql(h: int):
    specs = [("Persistence", f"lag(y, {h})"),
             ("RollingMean_24h", f"avg(y) OVER_ROLL({h + 24 - 1},{h})"),
             ("RollingMean_168h", f"avg(y) OVER_ROLL({h + 168 - 1},{h})"),
             ("SeasonalNaive_168h", "lag(y, 168)")]
    if h <= 24:
        specs.append(("SeasonalNaive_24h", "lag(y, 24)"))
    return specs


def baselines(src: str = "split", horizons=C.HORIZONS, only: str | None = None, name: str = "preds") -> str:
    ww = "PARTITION BY station_id, horizon ORDER BY pos"
    sels = []
    for h in horizons:
        for model, expr in baseline_specs_sql(h):
            if only and model != only:
                continue
            if "OVER_ROLL" in expr:
                a, b = expr.split("OVER_ROLL(")[1].rstrip(")").split(",")
                n = int(a) - int(b) + 1
                fr = f"OVER ({ww} ROWS BETWEEN {a} PRECEDING AND {b} PRECEDING)"
                # full frames: explicit oldest-first sum (Spark's sliding-frame order)
                chain = " + ".join(f"lag(y, {k}) OVER ({ww})" for k in range(int(a), int(b) - 1, -1))
                e = f"CASE WHEN count(y) {fr} = {n} THEN ({chain}) / {float(n)!r} ELSE avg(y) {fr} END"
            else:
                e = f"{expr} OVER ({ww})"
            sels.append(f"SELECT station_id, horizon, '{model}' AS model, date, y, split, {e} AS p "
                        f"FROM {src} WHERE horizon = {h}")
    return f"""{name}_raw AS ({' UNION ALL '.join(sels)}),
{name}_tm AS (SELECT station_id, horizon, avg(CASE WHEN split = 'train' THEN y END) AS tm
              FROM {src} GROUP BY 1, 2),
{name} AS (SELECT r.station_id, r.horizon, r.model, r.date, r.y, coalesce(r.p, t.tm) AS yhat
           FROM {name}_raw r JOIN {name}_tm t USING (station_id, horizon) WHERE r.split = 'test')"""


def metrics(src: str = "preds", keys=("station_id", "horizon", "model"), name: str = "met") -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"a.{x} = b.{x}" for x in keys)
    return f"""{name}_m AS (SELECT *, yhat - y AS err FROM {src}
                WHERE y IS NOT NULL AND yhat IS NOT NULL AND NOT isnan(y) AND NOT isnan(yhat)),
{with_aqi(f'{name}_m', {'t': 'y', 'p': 'yhat'}, f'{name}_l')},
{name}_a AS (
  SELECT {k}, avg(abs(err)) AS mae, avg(err * err) AS mse, sum(err * err) AS sse,
         var_pop(y) * count(*) AS sst, count(*) AS n_test,
         count(*) FILTER (WHERE lvl_t IN {UNHEALTHY_SQL}) AS nt,
         count(*) FILTER (WHERE lvl_t IN {UNHEALTHY_SQL} AND lvl_p IN {UNHEALTHY_SQL}) AS ntp,
         quantile_cont(y, 0.95) AS p95
  FROM {name}_l GROUP BY {k}),
{name}_top AS (SELECT {', '.join('a.' + x for x in keys)}, avg(abs(a.err)) AS top
               FROM {name}_l a JOIN {name}_a b ON {on} WHERE a.y >= b.p95 GROUP BY {', '.join('a.' + x for x in keys)}),
{name} AS (
  SELECT {', '.join('a.' + x for x in keys)},
         {rnd('a.mae', 4)} AS MAE, {rnd('sqrt(a.mse)', 4)} AS RMSE,
         {rnd('CASE WHEN a.sst = 0 THEN CASE WHEN a.sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - a.sse / a.sst END', 6)} AS R2,
         {rnd('CASE WHEN a.nt > 0 THEN a.ntp / a.nt ELSE 0.0 END', 6)} AS recall_unhealthy_plus,
         {rnd('b.top', 4)} AS mae_top5, {rnd('a.p95', 4)} AS threshold_95, CAST(a.n_test AS INTEGER) AS n_test
  FROM {name}_a a LEFT JOIN {name}_top b ON {on})"""


BASELINE_ORDER = ["Persistence", "RollingMean_24h", "RollingMean_168h", "SeasonalNaive_168h", "SeasonalNaive_24h"]


def meta(src: str = "met", mode: str = "operational", name: str = "meta") -> str:
    order = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(BASELINE_ORDER)) + " ELSE 99 END"
    return f"""{name} AS (SELECT '{mode}' AS mode, *, 'ok' AS status, '' AS error, 'corrected_baseline' AS "group",
       0 AS complexity_rank, 0.0::DOUBLE AS runtime_seconds, false AS tuned, '' AS best_params,
       {order} AS spec_order FROM {src})"""


def selection(src: str = "meta", name: str = "sel") -> str:
    g = "PARTITION BY station_id, mode, horizon"
    return f"""{name}_r AS (
  SELECT *, CASE WHEN status = 'ok' AND MAE IS NOT NULL
                 THEN CAST(rank() OVER ({g}, (status = 'ok' AND MAE IS NOT NULL) ORDER BY MAE) AS DOUBLE) END AS rank_mae,
         min(CASE WHEN status = 'ok' AND MAE IS NOT NULL THEN MAE END) OVER ({g}) AS _min
  FROM {src}),
{name}_c AS (SELECT *, (status = 'ok' AND MAE IS NOT NULL AND MAE <= _min * 1.01::DOUBLE) AS _cand FROM {name}_r),
{name} AS (
  SELECT * EXCLUDE (_min, _cand, _rn), coalesce(_cand AND _rn = 1, false) AS selected_champion
  FROM (SELECT *, row_number() OVER ({g}, _cand ORDER BY complexity_rank, runtime_seconds, MAE, spec_order) AS _rn
        FROM {name}_c))"""

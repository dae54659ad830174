"""Cleaning steps against pandas on hand-made fixtures; block layout invariance."""
import datetime as dt

import numpy as np
import pandas as pd

from hourcast.operators import clean as CL
from hourcast.operators.series import POS

T0 = dt.datetime(2024, 1, 1)


def fixture_series():
    v = [None] * 4 + [1.0, None, 3.0, None, None, 6.0, None, None, None, 10.0, None, None, None, None, 20.0]
    v += [None] * 12 + [5.0, 7.0] + [None] * 6
    return v


def pandas_ref(v):
    s = pd.Series(v, dtype=float)
    s = s.interpolate(method="linear", limit=3).ffill()
    first = s.first_valid_index()
    return s.fillna(s.loc[first] if first is not None else 0.0).to_numpy()


def _frame(spark, cols):
    n = len(next(iter(cols.values())))
    rows = [("s1", T0 + dt.timedelta(hours=i), *[cols[c][i] for c in cols]) for i in range(n)]
    schema = "station_id string, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame(rows, schema)


def test_fill_matches_pandas(spark):
    v = fixture_series()
    allnull = [None] * len(v)
    df = _frame(spark, {"a": v, "b": allnull})
    for block in (5, 8192):
        out = CL.fill_capped(df, ["a", "b"], block=block).orderBy("datetime").toPandas()
        np.testing.assert_allclose(out["a"].to_numpy(), pandas_ref(v), rtol=0, atol=1e-12)
        assert (out["b"] == 0.0).all()


def test_interpolate_and_ffill_steps(spark):
    v = fixture_series()
    df = _frame(spark, {"a": v})
    got = CL.interpolate_capped(df, ["a"], block=7).orderBy("datetime").toPandas()["a"].to_numpy(dtype=float)
    ref = pd.Series(v, dtype=float).interpolate(method="linear", limit=3).to_numpy()
    np.testing.assert_allclose(got, ref, equal_nan=True)
    got = CL.forward_fill(df, ["a"], block=3).orderBy("datetime").toPandas()["a"].to_numpy(dtype=float)
    np.testing.assert_allclose(got, pd.Series(v, dtype=float).ffill().to_numpy(), equal_nan=True)


def test_trim_happens_before_outliers(spark):
    v = [None, None, -5.0, 3.0, 4.0, None, 6.0, 7.0, 8.0, 9.0]
    aq = spark.createDataFrame([("s1", T0 + dt.timedelta(hours=i), x, 1.0) for i, x in enumerate(v)],
                               "station_id string, datetime timestamp_ntz, pm2_5 double, pm10 double")
    out = CL.clean_series(aq).orderBy("datetime").toPandas()
    assert len(out) == 8  # trimmed at the -5 reading, which then becomes a (filled) outlier
    assert out["pm2_5_missing_flag"].tolist()[:2] == [1, 0]
    assert out["pm2_5"].iloc[0] == 3.0  # leading fill with the first valid value


def test_bounds_inclusive(spark):
    df = _frame(spark, {"pm2_5": [0.0, 1000.0, -0.01, 1000.01]})
    got = CL.null_outliers(df).orderBy("datetime").toPandas()["pm2_5"].tolist()
    assert got[:2] == [0.0, 1000.0] and all(pd.isna(got[2:]))


def test_grid_and_dedupe(spark):
    rows = [("s1", T0 + dt.timedelta(hours=3), 3, 1.0), ("s1", T0, 1, 2.0), ("s1", T0, 0, 9.0),
            ("s1", T0 + dt.timedelta(hours=1, minutes=30), 5, 4.0)]
    r = spark.createDataFrame(rows, "station_id string, datetime timestamp_ntz, seq long, pm2_5 double")
    d = CL.dedupe_hourly(r).orderBy("datetime").collect()
    assert [x.pm2_5 for x in d][:1] == [9.0]
    g = CL.hourly_grid(CL.dedupe_hourly(r).drop("seq"), block=2).orderBy(POS).toPandas()
    assert len(g) == 4 and g["pm2_5"].isna().sum() == 2  # the reading at half past one is off the grid


def test_off_grid_readings_vanish_and_the_first_time_anchors(spark):
    m = lambda h, k: T0 + dt.timedelta(hours=h, minutes=k)
    rows = [("s1", m(0, 30), 1.0), ("s1", m(1, 0), 7.0), ("s1", m(1, 30), 2.0), ("s1", m(3, 30), 4.0), ("s1", m(4, 10), 9.0),
            ("s2", m(0, 0), 1.0), ("s2", m(1, 30), 8.0), ("s2", m(2, 0), 3.0), ("s2", m(2, 30), 5.0)]
    aq = spark.createDataFrame(rows, "station_id string, datetime timestamp_ntz, pm2_5 double")
    got = [(r.station_id, r.datetime, r.pm2_5) for r in CL.hourly_grid(aq, block=2).orderBy("station_id", "datetime").collect()]
    assert got == [("s1", m(0, 30), 1.0), ("s1", m(1, 30), 2.0), ("s1", m(2, 30), None), ("s1", m(3, 30), 4.0),
                   ("s2", m(0, 0), 1.0), ("s2", m(1, 0), None), ("s2", m(2, 0), 3.0)]
    weather = spark.createDataFrame([(m(0, 0), 20.0), (m(1, 0), 21.0)], "datetime timestamp_ntz, temperature_2m double")
    got = CL.merge_outer(aq.filter("station_id = 's1'"), weather).orderBy("datetime").collect()
    assert [(r.datetime, r.pm2_5, r.temperature_2m) for r in got] == [(m(0, 0), None, 20.0), (m(1, 0), 7.0, 21.0)]


def test_outliers_of_a_series_become_flagged_gaps(spark):
    v = [5.0, -1.0, 7.0, 5000.0, 9.0]
    aq = spark.createDataFrame([("s1", T0 + dt.timedelta(hours=i), x) for i, x in enumerate(v)], "station_id string, datetime timestamp_ntz, pm2_5 double")
    out = CL.clean_series(aq).orderBy("datetime").toPandas()
    assert out["pm2_5"].tolist() == [5.0, 6.0, 7.0, 8.0, 9.0]
    assert out["pm2_5_missing_flag"].tolist() == [0, 1, 0, 1, 0]


def test_block_invariance_panel(spark):
    from conftest import SF001
    from hourcast.plans.common import rounded
    from hourcast.operators.features import feature_table
    from hourcast.sources.panel import aq_hourly, weather_hourly
    aq, w = aq_hourly(spark, SF001), weather_hourly(spark, SF001)
    a = rounded(feature_table(CL.clean_series(aq, w, block=50), block=50))
    b = rounded(feature_table(CL.clean_series(aq, w)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_feature_plan_has_no_station_only_window(spark):
    """Every feature window is partitioned by (station_id, _blk); lag, rolling
    and lead columns share one Window node."""
    import re

    from conftest import SF001
    from hourcast.operators.features import build_features
    from hourcast.plans.common import panel_clean
    plan = build_features(panel_clean(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if re.search(r"\bWindow \[", ln)]
    assert len(windows) == 1
    assert all("_blk" in ln for ln in windows)

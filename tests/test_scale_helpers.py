"""Scalable helpers against direct computations."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from hourcast.operators.series import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.RandomState(1)
    sizes = {"a": 3000, "b": 7, "c": 1, "d": 40}
    rows = [(k, float(v)) for k, n in sizes.items() for v in np.round(rng.gamma(2, 20, size=n), 1)]
    df = spark.createDataFrame(rows, "key string, v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.key: r.q for r in exact_quantiles(df, "v", ["key"], probs, bins=16).collect()}
    sp = {r.key: r.q for r in df.groupBy("key").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    for k in sizes:
        ref = np.percentile([v for kk, v in rows if kk == k], [p * 100 for p in probs])
        np.testing.assert_allclose(np.array(got[k]), ref, rtol=1e-13)
        assert got[k] == sp[k]  # bit-identical to Spark's buffering percentile


def test_series_index_and_tail_with_small_blocks(spark):
    from hourcast.operators.prep import series_index
    from hourcast.operators.serve import tail_rows
    t0 = dt.datetime(2024, 1, 1)
    hours = [h for h in range(300) if h % 7 != 3]  # gaps: not contiguous
    rows = [("s", t0 + dt.timedelta(hours=h), float(h)) for h in hours] + [("t", t0, 1.0)]
    df = spark.createDataFrame(rows, "station_id string, datetime timestamp_ntz, v double")
    idx = series_index(df, block=16).filter("station_id = 's'").orderBy("datetime").select("idx", "n").collect()
    assert [r.idx for r in idx] == list(range(len(hours))) and idx[0].n == len(hours)
    tail = tail_rows(df, 10, order="datetime", block=16).filter("station_id = 's'").select("v").collect()
    assert sorted(r.v for r in tail) == [float(h) for h in hours[-10:]]
    assert tail_rows(df, 10, order="datetime", block=16).filter("station_id = 't'").count() == 1


def test_spearman_matches_pandas(spark):
    import pandas as pd

    from hourcast.operators.eda import spearman_matrix
    rng = np.random.RandomState(3)
    n = 500
    x = np.round(rng.normal(size=n), 1)
    pdf = pd.DataFrame({"station_id": "s", "datetime": pd.date_range("2024-01-01", periods=n, freq="h"),
                        "pm2_5": x, "pm10": np.round(x * 2 + rng.normal(size=n), 1),
                        "temperature_2m": np.round(rng.normal(size=n), 0)})
    df = spark.createDataFrame(pdf).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    got = {(r.col_a, r.col_b): r.rho for r in spearman_matrix(df).collect()}
    ref = pdf[["pm2_5", "pm10", "temperature_2m"]].corr(method="spearman")
    for (a, b), rho in got.items():
        assert abs(rho - ref.loc[a, b]) < 1e-12


def test_spearman_of_constant_columns_is_nan(spark):
    """A column that is constant in one station, as the hourly maximum of dense readings is, is no error."""
    import math

    from hourcast.operators.eda import spearman_matrix
    t0 = dt.datetime(2024, 1, 1)
    rows = [(s, t0 + dt.timedelta(hours=h), float(h * h % 11), 99.0 if s == "flat" else float(h)) for s in ("flat", "s") for h in range(40)]
    rows.append(("one", t0, 1.0, 2.0))
    df = spark.createDataFrame(rows, "station_id string, datetime timestamp_ntz, pm2_5 double, relative_humidity_2m double")
    got = {(r.station_id, r.col_a[:2], r.col_b[:2]): r.rho for r in spearman_matrix(df).collect()}
    assert len(got) == 9
    assert math.isnan(got["flat", "re", "pm"]) and math.isnan(got["flat", "re", "re"]) and abs(got["flat", "pm", "pm"] - 1) < 1e-12
    assert abs(got["s", "re", "re"] - 1) < 1e-12 and abs(got["s", "re", "pm"]) < 1
    assert got["one", "re", "pm"] is None

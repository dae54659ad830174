"""Champion export, loading by precedence, rolling origins against direct fits, repeatable stream batches, the entry
without the optional subpackage."""
import json
import os
import shutil
import subprocess
import sys
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.operators import models as M
from hourcast.operators import trees as T
from hourcast.plans import champion as CH

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.RandomState(0)
    frames = []
    for s in ("a", "b"):
        for h in (1, 24):
            x = r.randn(90, len(C.FEATURES)).round(2)
            d = pd.DataFrame(x, columns=C.FEATURES).assign(station_id=s, horizon=h, idx=np.arange(90), y=30 + 3 * x[:, 0] - x[:, 1] + r.randn(90) / 9)
            frames.append(d.assign(date=pd.Timestamp("2024-03-01") + pd.to_timedelta(np.arange(90), "h")))
    return spark.createDataFrame(pd.concat(frames)).withColumn("horizon", F.col("horizon").cast("int")).withColumn("date", F.col("date").cast("timestamp_ntz")).cache()


def metrics(spark, groups):
    """(station, horizon, model, group, MAE, best_params); the first of each group is the champion."""
    out, seen = [], set()
    for s, h, model, group, mae, params in groups:
        out.append((s, h, "operational", model, group, 1, 0.1, mae, mae, 0.5, 0.5, mae, "ok", "", params, float(len(seen)), (s, h) not in seen))
        seen.add((s, h))
    df = spark.createDataFrame(out, "station_id string, horizon int, mode string, model string, group string, complexity_rank int, runtime_seconds double, MAE double, "
                                    "RMSE double, R2 double, recall_unhealthy_plus double, mae_top5 double, status string, error string, best_params string, "
                                    "order_in double, selected_champion boolean")
    return df.withColumn("rank_mae", F.col("MAE")).withColumn("spec_order", F.col("order_in").cast("int")).drop("order_in")


TUNED = json.dumps({"alpha": 50.0})
CHOICE = [("a", 1, "Ridge", "tabular_linear", 1.0, TUNED), ("a", 1, "XGBoost", "tabular_boosting", 2.0, ""),
          ("a", 24, "Persistence", "corrected_baseline", 1.0, ""), ("a", 24, "ExtraTrees", "tabular_tree", 3.0, ""), ("a", 24, "Ridge", "tabular_linear", 4.0, ""),
          ("b", 1, "LinearRegression", "tabular_linear", 1.0, "")]


def test_export_load_and_precedence(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setitem(C.TREE_PRESETS, "ExtraTrees", dict(trees=5, depth=4, min_leaf=2, random_cuts=True))
    root = f"file://{tmp_path}/champions"
    assert CH.Champions(spark, root).version is None
    assert {r.source for r in CH.Champions(spark, root).predict(rows, ["date"]).collect()} == {"missing"}
    assert CH.export_champions(metrics(spark, CHOICE), rows, root) == 1
    loaded = CH.Champions(spark, root, legacy=spark.createDataFrame([("b", 24, 5.0, [0.0] * len(C.FEATURES)), ("a", 1, 9.0, [0.0] * len(C.FEATURES))],
                                                                    "station_id string, horizon int, intercept double, coef array<double>"))
    entries = {(r.station_id, r.horizon): r for r in loaded.manifest.collect()}
    assert {k: r.model_name for k, r in entries.items()} == {("a", 1): "Ridge", ("a", 24): "ExtraTrees", ("b", 1): "LinearRegression"}
    assert all(r.train_rows == 90 and r.version == 1 and r.created_at for r in entries.values())
    assert entries["a", 24].artifact_path.endswith("version=1/trees") and entries["a", 1].artifact_path.endswith("version=1/linear")
    got = loaded.predict(rows, ["date", "y"]).toPandas()
    assert len(got) == 360
    by = {k: g.sort_values("date") for k, g in got.groupby(["station_id", "horizon"])}
    assert set(by["b", 24].source) == {"legacy"} and set(by["b", 24].prediction) == {5.0} and set(by["a", 1].label) == {"Champion: Ridge"}
    pdf = rows.toPandas()
    own = pdf[(pdf.station_id == "a") & (pdf.horizon == 1)].sort_values("date")
    x, y = own[C.FEATURES].to_numpy(float), own.y.to_numpy()
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    w = np.linalg.solve(z.T @ z + 50.0 * np.eye(x.shape[1]), z.T @ (y - y.mean()))  # the tuned parameter, all rows
    assert np.allclose(by["a", 1].prediction, y.mean() + z @ w)
    assert np.corrcoef(by["a", 24].prediction, by["a", 24].y)[0, 1] > 0.7
    card = {(r.station_id, r.horizon): r.card for r in CH.cards(loaded).collect()}
    assert card["a", 1].startswith("# Ridge t+1 a\n") and "- Train rows: 90" in card["a", 1]


def test_a_half_written_version_is_never_read(spark, rows, tmp_path):
    root = f"file://{tmp_path}/champions"
    only = [c for c in CHOICE if c[2] in ("Ridge", "LinearRegression") and c[1] == 1]
    assert CH.export_champions(metrics(spark, only), rows, root) == 1
    folder = tmp_path / "champions" / "version=2" / "linear"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_text("broken")
    assert CH.Champions(spark, root).version == 1
    assert CH.export_champions(metrics(spark, only), rows, root) == 3
    loaded = CH.Champions(spark, root)
    assert loaded.version == 3 and loaded.predict(rows.filter("horizon = 1"), ["date"]).filter("source = 'champion'").count() == 180


def test_no_deployable_model_is_an_error(spark):
    with pytest.raises(ValueError, match="no deployable model"):
        CH.champions_to_deploy(metrics(spark, [("a", 1, "Persistence", "corrected_baseline", 1.0, "")]))


def test_nowcast_takes_the_row_of_the_previous_full_hour(spark, rows, tmp_path):
    root = f"file://{tmp_path}/champions"
    CH.export_champions(metrics(spark, [c for c in CHOICE if c[2] in ("Ridge", "LinearRegression") and c[1] == 1]), rows, root)
    f = rows.filter("horizon = 1").drop("horizon", "y", "idx").filter("station_id = 'a' or date < timestamp_ntz'2024-03-02 00:00:00'")
    got = {r.station_id: r for r in CH.nowcast(CH.Champions(spark, root), f, "2024-03-03 05:40:00").collect()}
    assert str(got["a"].date) == "2024-03-03 04:00:00" and str(got["a"].target_time) == "2024-03-03 05:00:00"
    assert str(got["b"].date) == "2024-03-01 23:00:00" and got["b"].level is not None


def test_rolling_origins_against_direct_fits(spark):
    r = np.random.RandomState(3)
    data, start = [], datetime(2024, 1, 1)
    for s in ("a", "b"):
        for h in (1, 3):
            x = r.randn(60, 2)
            data += [(s, h, start + timedelta(hours=i), float(2 * x[i, 0] - x[i, 1] + r.randn() / 5), x[i].tolist()) for i in range(60)]
    df = spark.createDataFrame(data, "station_id string, horizon int, date timestamp, y double, xw array<double>").withColumn("date", F.col("date").cast("timestamp_ntz"))
    cutoffs = [start + timedelta(hours=k) for k in (30, 40, 50)]
    origins = spark.createDataFrame([(s, cutoffs) for s in ("a", "b")], "station_id string, cutoffs array<timestamp>").withColumn("cutoffs", F.col("cutoffs").cast("array<timestamp_ntz>"))
    got = {(x.station_id, x.horizon, x.window): x.yhat for x in M.rolling_origin_forecasts(df, ("xw", 2), origins).collect()}
    assert len(got) == 12
    for (s, h, w), yhat in got.items():
        known = [(x, y) for t, k, date, y, x in data if (t, k) == (s, h) and date + timedelta(hours=h) <= cutoffs[w]]
        x, y = np.array([k[0] for k in known]), np.array([k[1] for k in known])
        mu, sd = x.mean(0), x.std(0)
        z = (x - mu) / sd
        coef = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean()))
        at = np.array(next(x for t, k, date, _, x in data if (t, k) == (s, h) and date == cutoffs[w]))
        assert np.isclose(yhat, y.mean() + ((at - mu) / sd) @ coef)


def test_a_repeated_stream_batch_changes_nothing(spark, tmp_path):
    from hourcast.streaming import ingest as S
    start = pd.Timestamp("2024-01-01")

    def land(first, n):
        pdf = pd.DataFrame({"event_id": np.arange(first, first + n), "ts": start + pd.to_timedelta(np.arange(first, first + n) * 20, "m"), "user_id": 1,
                            "event_type": "s", "value": np.arange(first, first + n, dtype=float), "props": ""})
        spark.createDataFrame(pdf).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        df = S.stream_hourly_avg(S.read_readings_stream(spark, str(tmp_path / "in"), "*.parquet"))
        S.stream_append_batches(df, str(tmp_path / "lake"), str(tmp_path / "check")).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "lake")).select("datetime", "pm2_5", "n").collect())

    land(0, 60)
    first = run()
    assert len(first) == 17  # windows that end two hours before the last reading
    commits = [p for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit()]
    os.remove(max(commits, key=lambda p: int(p.name)))  # the last batch was written, its commit lost
    for p in (tmp_path / "check" / "commits").iterdir():
        if p.name.startswith("."):
            os.remove(p)
    assert run() == first
    land(60, 30)
    got = run()
    assert len(got) == 27 and [g[1] for g in got] == [3.0 * k + 1 for k in range(27)]


def test_entry_without_the_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    code = "import __spark_entry__ as E; q, s = E.queries(), E.oracle_sql(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(s) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-800:]

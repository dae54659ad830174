"""Split arithmetic and the champion rule on the published metrics."""
import os

import pandas as pd
from pyspark.sql import functions as F

from hourcast.operators import select as SEL
from hourcast.operators.prep import split_bounds

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "published_metrics.csv")


def test_split_bounds(spark):
    ns = [10, 100, 10859, 10836, 10812, 10788]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    te, ve = split_bounds(F.col("n"))
    got = [r[0] for r in df.select(ve.cast("long")).collect()]
    assert got == [7, 80, 8687, 8668, 8649, 8630]
    test_sizes = [n - v for n, v in zip(ns, got)]
    assert test_sizes[2:] == [2172, 2168, 2163, 2158]


def test_golden_selection(spark):
    pdf = pd.read_csv(FIX)
    pdf["mode"] = "operational"
    pdf["status"] = "ok"
    pdf["spec_order"] = range(len(pdf))
    df = spark.createDataFrame(pdf)
    sel = SEL.select_champion(SEL.rank_models(df)).toPandas()
    assert (sel["rank_mae"] == sel["rank_published"]).all()
    champ = sel[sel.selected_champion].sort_values("horizon")["model"].tolist()
    assert champ == ["Ridge", "ElasticNet", "WindowRidge_168h", "WindowRidge_168h"]
    dep = SEL.deployable_champion(spark.createDataFrame(sel.drop(columns=["rank_published", "champion_published"])))
    got = [r.deployable_model for r in dep.orderBy("horizon").collect()]
    assert got == ["Ridge", "ElasticNet", "ElasticNet", "ElasticNet"]


def test_error_rows_not_ranked(spark):
    rows = [("operational", 1, "a", "g", 0, 0.0, 1.0, "ok", 0), ("operational", 1, "b", "g", 0, 0.0, None, "error", 1),
            ("operational", 1, "c", "g", 0, 0.0, 1.0, "ok", 2)]
    df = spark.createDataFrame(rows, "mode string, horizon int, model string, group string, complexity_rank int, "
                                     "runtime_seconds double, MAE double, status string, spec_order int")
    out = {r.model: r for r in SEL.select_champion(df).collect()}
    assert out["b"].rank_mae is None and not out["b"].selected_champion
    assert out["a"].rank_mae == out["c"].rank_mae == 1.0 and out["a"].selected_champion

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hourcast.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from hourcast.plans import benchmark as BM
    from hourcast.plans import common as P
    from hourcast.plans import models as PM
    from hourcast.plans.queries import REGISTRY

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if out is not None:
            out.collect()
        times[name] = round(time.perf_counter() - t0, 3)

    # stage 1: raw events -> clean hourly panel -> 50-column feature table (materialized)
    timed("clean_features", lambda: P.panel_features(spark, sf_dir))
    # stage 2: chronological split of every (station, horizon) series (materialized)
    timed("split", lambda: P.panel_split(spark, sf_dir))
    # flagship: persistence metrics per station x horizon
    timed("persistence_metrics", lambda: REGISTRY["persistence_metrics"](spark, sf_dir))
    # all baselines -> metrics -> ranking -> champion rule
    timed("baseline_selection", lambda: BM.baseline_selection(P.panel_split(spark, sf_dir)))
    # per-series linear models from one Gram pass
    split = P.panel_split(spark, sf_dir)
    specs = {s.name: s for s in PM.model_specs()}
    timed("ridge", lambda: specs["Ridge"].build(split, False, "Ridge"))
    timed("ridge_tuned_cv", lambda: specs["Ridge"].build(split, True, "Ridge"))
    timed("elastic_net", lambda: specs["ElasticNet"].build(split, False, "ElasticNet"))
    timed("window_ridge_168h", lambda: specs["WindowRidge_168h"].build(split, False, "WindowRidge_168h"))
    timed("arma_regression", lambda: specs["SARIMAX"].build(split, False, "SARIMAX"))
    # trees at their published sizes, one ensemble per series
    timed("random_forest_300", lambda: specs["RandomForest"].build(split, False, "RandomForest"))
    timed("extra_trees_300", lambda: specs["ExtraTrees"].build(split, False, "ExtraTrees"))
    timed("xgboost_500", lambda: specs["XGBoost"].build(split, False, "XGBoost"))
    # analysis and serving
    for q in ("acf", "spearman_matrix", "seasonal_decompose", "backtest_k1_k3", "latest_actual",
              "nowcast_validation"):
        timed(q, lambda q=q: REGISTRY[q](spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Ranking and champion selection over a metrics table (F8 + station_id).

Groups are (station_id, mode, horizon): a handful of model rows each, so the
window functions here run over tiny partitions regardless of data size.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C

GROUP_KEYS = ["station_id", "mode", "horizon"]


def _ok(df: DataFrame):
    return (F.col("status") == "ok") & F.col("MAE").isNotNull()


def _keys(df: DataFrame) -> list[str]:
    return [k for k in GROUP_KEYS if k in df.columns]


def rank_models(metrics: DataFrame) -> DataFrame:
    """``rank_mae`` = min-rank of MAE per group over ok rows (NULL otherwise)."""
    keys = _keys(metrics)
    w = Window.partitionBy(*keys, _ok(metrics).alias("_okp")).orderBy("MAE")
    return metrics.withColumn("rank_mae", F.when(_ok(metrics), F.rank().over(w).cast("double")))


def select_champion(metrics: DataFrame, tolerance: float = C.CHAMPION_TOLERANCE,
                    order_col: str = "spec_order") -> DataFrame:
    """Among ok rows with MAE <= tolerance * min MAE, the first by
    (complexity_rank, runtime_seconds, MAE, published order) is the champion."""
    keys = _keys(metrics)
    df = rank_models(metrics) if "rank_mae" not in metrics.columns else metrics
    okp = _ok(df)
    wmin = Window.partitionBy(*keys)
    df = df.withColumn("_min", F.min(F.when(okp, F.col("MAE"))).over(wmin))
    cand = okp & (F.col("MAE") <= F.col("_min") * F.lit(tolerance))
    tie = [F.col(order_col)] if order_col in df.columns else [F.col("model")]
    w = Window.partitionBy(*keys, cand.alias("_cand")).orderBy(
        F.col("complexity_rank").asc_nulls_last(), F.col("runtime_seconds").asc_nulls_last(),
        F.col("MAE").asc_nulls_last(), *tie)
    df = df.withColumn("selected_champion", F.coalesce(cand & (F.row_number().over(w) == 1), F.lit(False)))
    return df.drop("_min")


def deployable_champion(selected: DataFrame, deployable=None) -> DataFrame:
    """Per operational group: the champion if its model group is deployable,
    else the best deployable row by (rank_mae, complexity_rank, runtime).
    ``deployable_model`` is NULL when no candidate exists (callers raise)."""
    deployable = deployable or C.DEPLOYABLE_GROUPS
    keys = _keys(selected)
    op = selected.filter(F.col("mode") == "operational") if "mode" in selected.columns else selected
    champ = op.filter(F.col("selected_champion")).select(
        *keys, F.col("model").alias("champion"), F.col("group").alias("champion_group"))
    w = Window.partitionBy(*keys).orderBy(F.col("rank_mae").asc_nulls_last(), F.col("complexity_rank"),
                                          F.col("runtime_seconds"),
                                          *([F.col("spec_order")] if "spec_order" in op.columns else [F.col("model")]))
    best = (op.filter(_ok(op) & F.col("group").isin(*deployable))
              .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
              .select(*keys, F.col("model").alias("_best")))
    out = champ.join(best, keys, "left")
    return out.withColumn("deployable_model", F.when(F.col("champion_group").isin(*deployable), F.col("champion"))
                          .otherwise(F.col("_best"))).drop("_best")


def leaderboard(selected: DataFrame) -> DataFrame:
    return selected.filter((F.col("status") == "ok") & F.col("selected_champion"))


def final_leaderboard(selected: DataFrame) -> DataFrame:
    return leaderboard(selected).filter(F.col("mode") == "operational")


def group_order(col="group"):
    m = F.create_map(*[x for k, v in C.GROUP_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.col(col)], F.lit(C.UNKNOWN_GROUP_ORDER))


def combined_leaderboard(metrics: DataFrame) -> DataFrame:
    """ok + operational rows, ``tuned`` NULL -> false, group order 0..7 (99
    unknown) and the row's position in (horizon, group order, MAE) order."""
    ok = metrics.filter((F.col("status") == "ok") & (F.col("mode") == "operational"))
    ok = ok.withColumn("tuned", F.coalesce(F.col("tuned"), F.lit(False))).withColumn("group_order", group_order())
    keys = [k for k in ("station_id",) if k in ok.columns]
    w = Window.partitionBy(*keys, "horizon").orderBy("group_order", "MAE", "model")
    return ok.withColumn("position", F.row_number().over(w))


def compare_models(results: DataFrame, by: str = "MAE", keys=("station_id", "horizon")) -> DataFrame:
    """Average rank of ``by`` truncated to int (ties share the mean rank)."""
    keys = [k for k in keys if k in results.columns]
    w = Window.partitionBy(*keys).orderBy(by)
    wt = Window.partitionBy(*keys, by)
    avg_rank = F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0
    return results.withColumn("avg_rank", F.floor(avg_rank).cast("int"))


METRIC_COLUMNS = ["mode", "horizon", "status", "error", "model", "group", "complexity_rank", "runtime_seconds",
                  "MAE", "RMSE", "R2", "recall_unhealthy_plus", "mae_top5", "threshold_95", "n_test", "tuned",
                  "best_params"]


def metrics_union(*frames: DataFrame) -> DataFrame:
    """Concatenate metrics of several modes/runs; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def error_rows(spark, rows: list[dict]) -> DataFrame:
    """Error rows carry NULL metrics and n_test = 0."""
    schema = ("station_id string, mode string, horizon int, model string, group string, complexity_rank int, "
              "error string")
    df = spark.createDataFrame(rows, schema)
    return df.select("*", F.lit(0.0).alias("runtime_seconds"), F.lit("error").alias("status"),
                     F.lit(False).alias("tuned"), F.lit("").alias("best_params"),
                     *[F.lit(None).cast("double").alias(c) for c in
                       ("MAE", "RMSE", "R2", "recall_unhealthy_plus", "mae_top5", "threshold_95")],
                     F.lit(0).alias("n_test"))

"""Forecast metrics over a long prediction table (one aggregation for all
models): MAE, RMSE, R2, p95 threshold, MAE of the top 5 %, unhealthy recall,
AQI confusion matrix, accuracy and macro-F1."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.functions.aqi import is_unhealthy_level, pm25_level


def rnd(c, digits: int) -> Column:
    """round(x * 10^d) / 10^d — identical arithmetic in Spark and the oracle."""
    col = F.col(c) if isinstance(c, str) else c
    m = float(10 ** digits)
    return F.round(col * F.lit(m)) / F.lit(m)


def _masked(preds: DataFrame) -> DataFrame:
    return preds.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull()
                        & ~F.isnan("y") & ~F.isnan("yhat"))


def r2_expr(sse: Column, sst: Column) -> Column:
    """1 - sse/sst; constant truth -> 1.0 when perfect, else 0.0."""
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - sse / sst)


def regression_metrics(preds: DataFrame, keys=("station_id", "horizon", "model"), approx: bool = False) -> DataFrame:
    """Null-masked metrics per group: MAE(4dp) RMSE(4dp) R2(6dp)
    recall_unhealthy_plus(6dp) mae_top5(4dp) threshold_95(4dp) n_test."""
    keys = list(keys)
    d = _masked(preds).withColumn("_err", F.col("yhat") - F.col("y"))
    d = d.withColumn("_tu", is_unhealthy_level(pm25_level("y"))).withColumn("_pu", is_unhealthy_level(pm25_level("yhat")))
    agg = d.groupBy(*keys).agg(
        F.avg(F.abs("_err")).alias("_mae"),
        F.avg(F.col("_err") * F.col("_err")).alias("_mse"),
        F.sum(F.col("_err") * F.col("_err")).alias("_sse"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("_sst"),
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(F.col("_tu")).alias("_nt"),
        F.count_if(F.col("_tu") & F.col("_pu")).alias("_ntp"),
        # the exact p95 of the truth: distinct values are counted map-side, and a group is bounded by the calendar
        (F.percentile_approx("y", 0.95, 10000) if approx else F.percentile("y", 0.95)).alias("_p95"))
    # MAE over rows at or above the group's own p95 (small per-group table joined back)
    top = (d.join(agg.select(*keys, "_p95"), keys)
             .filter(F.col("y") >= F.col("_p95"))
             .groupBy(*keys).agg(F.avg(F.abs("_err")).alias("_top")))
    out = agg.join(top, keys, "left")
    return out.select(
        *keys,
        rnd("_mae", 4).alias("MAE"),
        rnd(F.sqrt("_mse"), 4).alias("RMSE"),
        rnd(r2_expr(F.col("_sse"), F.col("_sst")), 6).alias("R2"),
        rnd(F.when(F.col("_nt") > 0, F.col("_ntp") / F.col("_nt")).otherwise(F.lit(0.0)), 6)
        .alias("recall_unhealthy_plus"),
        rnd("_top", 4).alias("mae_top5"),
        rnd("_p95", 4).alias("threshold_95"),
        F.col("n_test").cast("int").alias("n_test"))


def mae_rmse_r2(preds: DataFrame, keys=("station_id", "horizon", "model")) -> DataFrame:
    """Unmasked legacy metrics rounded 2 / 2 / 4."""
    keys = list(keys)
    d = preds.withColumn("_err", F.col("yhat") - F.col("y"))
    agg = d.groupBy(*keys).agg(F.avg(F.abs("_err")).alias("_mae"), F.avg(F.col("_err") ** 2).alias("_mse"),
                               F.sum(F.col("_err") ** 2).alias("_sse"),
                               (F.var_pop("y") * F.count("y")).alias("_sst"))
    return agg.select(*keys, rnd("_mae", 2).alias("MAE"), rnd(F.sqrt("_mse"), 2).alias("RMSE"),
                      rnd(r2_expr(F.col("_sse"), F.col("_sst")), 4).alias("R2"))


def _levels(preds: DataFrame) -> DataFrame:
    return _masked(preds).withColumn("_tl", pm25_level("y")).withColumn("_pl", pm25_level("yhat"))


LABELS = [lv[1] for lv in C.AQI_LEVELS]


def aqi_confusion(preds: DataFrame, keys=("station_id", "horizon", "model")) -> DataFrame:
    """6x6 counts (true level rows x predicted level columns), zero-filled, fixed
    label order; computed as 36 conditional counts in one aggregation."""
    keys = list(keys)
    d = _levels(preds)
    cells = [F.count_if((F.col("_tl") == t) & (F.col("_pl") == p)).alias(f"c_{i}_{j}")
             for i, t in enumerate(LABELS) for j, p in enumerate(LABELS)]
    agg = d.groupBy(*keys).agg(*cells)
    rows = F.array(*[F.struct(F.lit(i).alias("true_idx"), F.lit(t).alias("true_level"),
                              *[F.col(f"c_{i}_{j}").cast("long").alias(f"pred_{j}") for j in range(len(LABELS))])
                     for i, t in enumerate(LABELS)])
    out = agg.select(*keys, F.inline(rows))
    return out


def aqi_accuracy(preds: DataFrame, keys=("station_id", "horizon", "model")) -> DataFrame:
    d = _levels(preds)
    return d.groupBy(*keys).agg(rnd(F.avg((F.col("_tl") == F.col("_pl")).cast("double")), 6).alias("accuracy"))


def f1_macro(preds: DataFrame, keys=("station_id", "horizon", "model")) -> DataFrame:
    """Macro F1 over all 6 labels (0 on zero division)."""
    keys = list(keys)
    d = _levels(preds)
    aggs = []
    for i, lab in enumerate(LABELS):
        aggs += [F.count_if((F.col("_tl") == lab) & (F.col("_pl") == lab)).alias(f"tp{i}"),
                 F.count_if((F.col("_tl") != lab) & (F.col("_pl") == lab)).alias(f"fp{i}"),
                 F.count_if((F.col("_tl") == lab) & (F.col("_pl") != lab)).alias(f"fn{i}")]
    agg = d.groupBy(*keys).agg(*aggs)
    f1s = []
    for i in range(len(LABELS)):
        den = 2 * F.col(f"tp{i}") + F.col(f"fp{i}") + F.col(f"fn{i}")
        f1s.append(F.when(den > 0, 2 * F.col(f"tp{i}") / den).otherwise(F.lit(0.0)))
    total = f1s[0]
    for f in f1s[1:]:
        total = total + f
    return agg.select(*keys, rnd(total / F.lit(float(len(LABELS))), 6).alias("f1_macro"))


def recall_unhealthy(preds: DataFrame, keys=("station_id", "horizon", "model")) -> DataFrame:
    d = _levels(preds)
    tu, pu = is_unhealthy_level(F.col("_tl")), is_unhealthy_level(F.col("_pl"))
    agg = d.groupBy(*keys).agg(F.count_if(tu).alias("_n"), F.count_if(tu & pu).alias("_k"))
    return agg.select(*keys, rnd(F.when(F.col("_n") > 0, F.col("_k") / F.col("_n")).otherwise(0.0), 6)
                      .alias("recall_unhealthy"))

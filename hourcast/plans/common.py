"""Shared plan pieces for the registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.clean import clean_series
from hourcast.operators.features import build_features, feature_table
from hourcast.operators.series import POS
from hourcast.session import input_stamp, materialized
from hourcast.sources.panel import aq_hourly, weather_hourly


def r6(c):
    """Round to 6 dp as round(x * 1e6) / 1e6 (same arithmetic as the oracle)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(1000000.0)) / F.lit(1000000.0)


def rounded(df: DataFrame, drop_internal: bool = True) -> DataFrame:
    cols = []
    for c, t in df.dtypes:
        if drop_internal and c.startswith("_"):
            continue
        cols.append(r6(F.col(f"`{c}`")).alias(c) if t in ("double", "float") else F.col(f"`{c}`"))
    return df.select(*cols)


def memo(spark: SparkSession, sf_dir: str) -> tuple:
    """Names an input as it is now: results that an application keeps are not those of files that have changed."""
    return (sf_dir, input_stamp(spark, sf_dir))


def panel_clean(spark: SparkSession, sf_dir: str, block: int | None = None) -> DataFrame:
    """Clean hourly panel (F5), written once per application and input."""
    return materialized(spark, "clean", (*memo(spark, sf_dir), block), lambda: clean_series(
        aq_hourly(spark, sf_dir), weather_hourly(spark, sf_dir), block=block))


def panel_features(spark: SparkSession, sf_dir: str, is_inference: bool = True,
                   block: int | None = None) -> DataFrame:
    """Feature/target table (F6), written once per application and input."""
    return materialized(spark, "features", (*memo(spark, sf_dir), is_inference, block), lambda: feature_table(
        panel_clean(spark, sf_dir, block), is_inference=is_inference, block=block))


def panel_split(spark: SparkSession, sf_dir: str, block: int | None = None) -> DataFrame:
    """(station, horizon) target series with idx / n / split."""
    from hourcast.plans.benchmark import split_all
    return materialized(spark, "split", (*memo(spark, sf_dir), block), lambda: split_all(panel_features(spark, sf_dir, block=block)))


__all__ = ["r6", "rounded", "panel_clean", "panel_features", "POS", "build_features"]

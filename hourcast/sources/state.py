"""Incremental-load state as small tables (replaces the JSON documents)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY, TIME


def high_watermark(state: DataFrame, keys=(KEY,), default: str = C.DEFAULT_WATERMARK,
                   expected: DataFrame | None = None) -> DataFrame:
    """Last loaded time per key, the default when nothing was loaded yet; every
    key of ``expected`` has a row, also when the state is empty."""
    keys = list(keys)
    out = state.groupBy(*keys).agg(F.max("last_data_time").alias("last_data_time"))
    if expected is not None:
        out = expected.select(*keys).distinct().join(out, keys, "full")
    return out.select(*keys, F.coalesce("last_data_time", F.lit(default).cast("timestamp_ntz")).alias("last_data_time"))


def advance_watermark(aq: DataFrame, weather: DataFrame, current: DataFrame | None = None,
                      aq_ok: bool = True, weather_ok: bool = True) -> DataFrame:
    """New watermark of every station known to the load or to ``current``:
    min(max aq, max weather) when both loaded rows; the one source's max when
    only one did; unchanged when none did, or when a source failed."""
    out = aq.groupBy(KEY).agg(F.max(TIME).alias("_aq"))
    if current is not None:
        out = out.join(current.select(KEY, F.col("last_data_time").alias("_cur")), KEY, "full")
    else:
        out = out.withColumn("_cur", F.lit(None).cast("timestamp_ntz"))
    # the shared weather feed's max is a scalar subquery; least() skips NULLs
    new = F.least(F.col("_aq"), weather.agg(F.max(TIME)).scalar())
    if not (aq_ok and weather_ok):
        new = F.lit(None).cast("timestamp_ntz")
    return out.select(KEY, F.coalesce(new, F.col("_cur")).alias("last_data_time"))


def needs_rebuild(raw_max: DataFrame, feature_max: DataFrame) -> DataFrame:
    """Rebuild iff raw max time > feature max time, or no feature metadata."""
    j = raw_max.select(KEY, F.col("max_time").alias("_raw")).join(
        feature_max.select(KEY, F.col("max_time").alias("_feat")), KEY, "left")
    return j.select(KEY, (F.col("_feat").isNull() | (F.col("_raw") > F.col("_feat"))).alias("needs_rebuild"))


def feature_state(features: DataFrame, raw: DataFrame, version: str = "1", generated_at=None) -> DataFrame:
    """One state row per station: generated_at, raw max, feature max, version."""
    r = raw.groupBy(KEY).agg(F.max(TIME).alias("raw_data_max_time"))
    f = features.groupBy(KEY).agg(F.max("date").alias("feature_data_max_time"))
    ts = (F.current_timestamp() if generated_at is None else F.lit(generated_at)).cast("timestamp_ntz")
    return r.join(f, KEY, "left").select(KEY, ts.alias("generated_at"), "raw_data_max_time",
                                         "feature_data_max_time", F.lit(version).alias("feature_version"))


def update_feature_state(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(path)


def staleness(features: DataFrame, as_of, max_age_hours: int = C.STALE_AFTER_HOURS) -> DataFrame:
    """Stale iff as_of - latest feature time > max_age_hours (strict, wall-clock
    arithmetic).  A station without any feature time is an error, as serving
    from it would be."""
    f = features.groupBy(KEY).agg(F.max("date").alias("feature_max"))
    known = F.when(F.col("feature_max").isNull(), F.raise_error(F.concat(F.lit("no feature time for station "), F.col(KEY))))
    stale = F.col("feature_max") + F.make_dt_interval(hours=F.lit(max_age_hours)) < F.lit(as_of).cast("timestamp_ntz")
    return f.select(KEY, "feature_max", F.coalesce(known.cast("boolean"), stale).alias("is_stale"))

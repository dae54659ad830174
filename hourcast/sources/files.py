"""File sources and sinks: landed sensor CSV / weather JSON payloads, the
year/month-partitioned Parquet lake, feature tables, reports, the champion
manifest and model artifacts (Spark ML persistence)."""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast import config as C
from hourcast.config import KEY, TIME

AQ_CSV_SCHEMA = T.StructType([T.StructField("time_stamp", T.LongType()),
                              T.StructField("pm2.5_atm", T.DoubleType()),
                              T.StructField("pm10.0_atm", T.DoubleType())])
WEATHER_JSON_SCHEMA = T.StructType([T.StructField("hourly", T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in C.WEATHER_COLUMNS]))])


def to_local_ntz(epoch_seconds, tz: str = C.LOCAL_TZ):
    """UTC epoch seconds -> local wall-clock TIMESTAMP_NTZ."""
    utc_wall = F.to_utc_timestamp(F.timestamp_seconds(epoch_seconds), F.current_timezone()).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def aq_from_csv_rows(raw: DataFrame, station_id: str | None = None) -> DataFrame:
    """Typed sensor rows: time_stamp (epoch s) -> local datetime, renames,
    keeps 3 columns; empty when ``time_stamp`` is absent."""
    if "time_stamp" not in raw.columns:
        return raw.sparkSession.createDataFrame([], f"{KEY} string, {TIME} timestamp_ntz, pm2_5 double, pm10 double")
    out = raw.select(to_local_ntz(F.col("time_stamp")).alias(TIME),
                     F.col("`pm2.5_atm`").cast("double").alias("pm2_5"),
                     F.col("`pm10.0_atm`").cast("double").alias("pm10"))
    sid = F.lit(station_id) if station_id else (F.col(KEY) if KEY in raw.columns else F.lit("default"))
    return out.select(sid.alias(KEY), "*")


def read_aq_csv(spark: SparkSession, path: str, station_id: str | None = None) -> DataFrame:
    raw = spark.read.option("header", True).schema(AQ_CSV_SCHEMA).csv(path)
    return aq_from_csv_rows(raw, station_id)


def weather_from_payload(payload: DataFrame) -> DataFrame:
    """Parallel arrays under ``hourly`` -> one row per hour (NULLs survive)."""
    h = payload.select("hourly.*")
    z = h.select(F.inline(F.arrays_zip("time", *C.WEATHER_COLUMNS)))
    return z.select(F.to_timestamp_ntz(F.col("time"), F.lit("yyyy-MM-dd'T'HH:mm")).alias(TIME), *C.WEATHER_COLUMNS)


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    return weather_from_payload(spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", True).json(path))


read_weather_forecast = read_weather_json  # same payload shape, no range filter


def filter_time_range(df: DataFrame, start, end, as_of, col: str = TIME) -> DataFrame:
    """Keep start < t <= min(end, as_of)."""
    t = F.col(col)
    return df.filter((t > F.lit(start).cast("timestamp_ntz"))
                     & (t <= F.least(F.lit(end).cast("timestamp_ntz"), F.lit(as_of).cast("timestamp_ntz"))))


def plan_time_chunks(ranges: DataFrame, days: int = C.CHUNK_DAYS) -> DataFrame:
    """[start, end) -> back-fill chunks of at most ``days`` days."""
    step = F.make_dt_interval(days=F.lit(days))
    starts = ranges.select("*", F.explode(F.sequence(F.col("start"), F.col("end"), step)).alias("chunk_start"))
    starts = starts.filter(F.col("chunk_start") < F.col("end"))
    return starts.withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col("end")))


def with_partitions(df: DataFrame, col: str = TIME) -> DataFrame:
    return df.withColumn("year", F.year(col)).withColumn("month", F.month(col))


def append_partitioned(df: DataFrame, lake: str, category: str) -> None:
    """Append to ``<lake>/raw/<category>`` partitioned by year/month."""
    with_partitions(df).write.mode("append").partitionBy("year", "month").parquet(f"{lake}/raw/{category}")


def read_partitioned(spark: SparkSession, lake: str, category: str) -> DataFrame:
    """Whole lake category with partition columns (pruned when filtered)."""
    return spark.read.parquet(f"{lake}/raw/{category}")


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy(KEY).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_features(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """Feature table (falls back to the clean table); time column as ``date``."""
    df = spark.read.parquet(path if fallback is None or path_exists(spark, path) else fallback)
    if "date" not in df.columns and TIME in df.columns:
        df = df.withColumnRenamed(TIME, "date")
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


RUNTIME_COLUMNS = ["mode", "horizon", "model", "group", "runtime_seconds", "status", "error"]


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(path)


def write_runtime_csv(metrics: DataFrame, path: str) -> None:
    cols = [c for c in ([KEY] + RUNTIME_COLUMNS) if c in metrics.columns]
    metrics.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def markdown_lines(table: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """Markdown rows of a (small, per-report) table as one text column."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols]
    return table.orderBy(*order).select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def write_markdown(table: DataFrame, path: str, cols: list[str], order: list[str]) -> None:
    """A (small, per-report) table as one Markdown text file in the given order."""
    head = [f"| {' | '.join(cols)} |", f"|{' --- |' * len(cols)}"]
    lines = markdown_lines(table, cols, order).agg(F.concat_ws("\n", F.array(*[F.lit(h) for h in head]), F.collect_list("line")).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)


def write_leaderboards(selected: DataFrame, out_dir: str) -> None:
    from hourcast.operators.select import combined_leaderboard, final_leaderboard, leaderboard
    leaderboard(selected).write.mode("overwrite").parquet(f"{out_dir}/leaderboard")
    final_leaderboard(selected).write.mode("overwrite").parquet(f"{out_dir}/final_leaderboard")
    combined = combined_leaderboard(selected)
    combined.write.mode("overwrite").parquet(f"{out_dir}/combined_leaderboard")
    write_markdown(combined, f"{out_dir}/combined_leaderboard_md", [KEY, "horizon", "group", "model", "MAE"], [KEY, "horizon", "position"])


MANIFEST_RULE = "lowest MAE; within 1%, simpler/faster wins"


def manifest_rows(champions: DataFrame, feature_columns: list[str], artifact_root: str = "models/champions") -> DataFrame:
    """Champion registry rows: one per (station, horizon)."""
    from hourcast.functions.text import safe_model_name
    return champions.select(
        *[c for c in (KEY,) if c in champions.columns], F.col("horizon").cast("int").alias("horizon"),
        F.col("model").alias("model_name"),
        F.concat(F.lit(f"{artifact_root}/t"), F.col("horizon"), F.lit("_"), safe_model_name("model"))
        .alias("artifact_path"),
        F.lit("operational").alias("forecast_mode"), F.lit(False).alias("uses_future_weather_forecast"),
        F.array(*[F.lit(c) for c in feature_columns]).alias("feature_columns"), F.lit(C.TARGET).alias("target"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("trained_at"),
        *[F.col(c) for c in ("train_rows", "MAE", "RMSE", "R2", "recall_unhealthy_plus", "mae_top5")
          if c in champions.columns], F.lit(MANIFEST_RULE).alias("selection_rule"))


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("m")).select("m.*")


def champion_entry(manifest: DataFrame, horizon: int) -> DataFrame:
    return manifest.filter(F.col("horizon") == horizon)


def write_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def read_model(candidates: list[tuple[str, str]]):
    """First existing artifact of an ordered candidate list (champion ->
    legacy ...) as (label, PipelineModel); (None, None) when none exists.  An
    artifact that exists but does not load is an error."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import SparkSession as _Session
    for label, path in candidates:
        if path_exists(_Session.getActiveSession(), path):
            return label, PipelineModel.load(path)
    return None, None


def write_model_card(skipped: DataFrame, path: str, meta: dict | None = None) -> None:
    """Run metadata, and skipped models (model, status, reason, mode) with reasons as JSON lines."""
    skipped.write.mode("overwrite").json(f"{path}/skipped")
    skipped.sparkSession.createDataFrame([(json.dumps(meta or {}, ensure_ascii=False),)], "value string") \
        .write.mode("overwrite").text(f"{path}/meta")

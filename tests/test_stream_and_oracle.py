"""Batch = stream for closed windows; a few registered queries vs the DuckDB oracle at sf0.001."""
import duckdb
from pyspark.sql import functions as F

from conftest import SF001


def test_stream_equals_batch_closed_windows(spark):
    from hourcast.streaming import ingest as S
    out = S.run_available(spark, S.stream_hourly_avg(S.read_readings_stream(spark, SF001)), "t").drop("year", "month")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    batch = ev.groupBy(F.col("event_type").alias("station_id"),
                       F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime")).agg(
        F.avg("value").alias("pm2_5"), F.count(F.lit(1)).alias("n"))
    assert out.count() > 0
    # every emitted (closed) window equals the batch aggregate
    assert out.exceptAll(batch.join(out.select("station_id", "datetime"), ["station_id", "datetime"])
                         .select(*out.columns)).count() == 0


def _check(spark, names):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("events", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    q, sql = E.queries(), E.oracle_sql()
    for n in names:
        df = q[n](spark, SF001)
        a = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
        res = con.execute(sql[n])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        b = sorted(map(repr, (tuple(r[i] for i in order) for r in res.fetchall())))
        assert sorted(df.columns) == sorted(cols), n
        assert a == b, n


def test_oracle_core(spark):
    _check(spark, ["clean_series", "build_features", "persistence_metrics", "select_champion", "pm25_to_aqi"])


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "MAE" in df.columns


def test_stream_dedupe_and_state(spark):
    from hourcast.sources import state as ST
    from hourcast.streaming import ingest as S
    out = S.run_available(spark, S.stream_dedupe(S.read_readings_stream(spark, SF001)), "dd")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    assert out.count() == ev.select("event_id").distinct().count()
    # watermark rule: both sources -> min of the maxima; one source -> its max
    aq = spark.createDataFrame([("s", "2024-01-02 00:00:00")], "station_id string, datetime string") \
        .withColumn("datetime", F.to_timestamp_ntz("datetime"))
    w = spark.createDataFrame([("2024-01-01 12:00:00",)], "datetime string") \
        .withColumn("datetime", F.to_timestamp_ntz("datetime"))
    got = ST.advance_watermark(aq, w).first().last_data_time
    assert str(got) == "2024-01-01 12:00:00"
    empty_w = w.limit(0)
    assert str(ST.advance_watermark(aq, empty_w).first().last_data_time) == "2024-01-02 00:00:00"
    stale = ST.staleness(aq.withColumnRenamed("datetime", "date"), "2024-01-02 06:00:00").first().is_stale
    stale2 = ST.staleness(aq.withColumnRenamed("datetime", "date"), "2024-01-02 06:00:01").first().is_stale
    assert stale is False and stale2 is True

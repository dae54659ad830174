"""Spark session helpers.

A cluster names its shared checkpoint folder in ``spark.checkpoint.dir``; we
read it from the session and only set our own when it is unset (tests, local
runs). Lineage is cut with Parquet tables written to that folder and read back
(``materialize``) — never with a local checkpoint.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "hourcast",
                extra: dict | None = None) -> SparkSession:
    """A session with the engine's defaults. ``master`` and ``shuffle_partitions``
    are for local runs and tests; left out, the submitted configuration decides."""
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which may not have it on their path."""
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    if getattr(spark, "_hourcast_shipped", False) or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="hourcast-"), "hourcast.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.join("hourcast", os.path.relpath(os.path.join(folder, n), root)))
    spark.sparkContext.addPyFile(archive)
    spark._hourcast_shipped = True


def checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; a scratch folder of our own
    only on a local master where nothing is configured (tests)."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="hourcast-ckpt-", dir=os.environ.get("HOURCAST_SCRATCH", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - Spark Connect raises on unknown keys
        v = None
    return int(v) if v not in (None, "") else default


def input_stamp(spark: SparkSession, folder: str) -> int:
    """A number that changes with the files of a folder of tables: names, sizes and modification times."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [path]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if status.isDirectory():
                todo.append(status.getPath())
            else:
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hash(tuple(sorted(found)))


_MATERIALIZED: dict = {}


def materialized(spark: SparkSession, name: str, memo_key: tuple, build) -> DataFrame:
    """``materialize(build(), ...)`` unless this application already wrote it."""
    key = (spark.sparkContext.applicationId, name, memo_key)
    if key in _MATERIALIZED:
        return spark.read.parquet(_MATERIALIZED[key])
    return materialize(build(), name, memo_key)


def materialize(df: DataFrame, name: str, memo_key: tuple | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: cuts lineage (a lost executor recomputes from the table, not
    from the raw inputs), computes the input once, and keeps column pruning and
    predicate pushdown for every later reader.  ``memo_key`` reuses a table
    already written in this application (inputs are immutable)."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    key = (app, name, memo_key) if memo_key is not None else None
    if key is not None and key in _MATERIALIZED:
        return spark.read.parquet(_MATERIALIZED[key])
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/hourcast-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    if key is not None:
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)

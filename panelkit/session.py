"""SparkSession construction and the checkpoint directory contract."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "panelkit",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings every operator assumes.

    UTC session time zone (timestamps in the driver tables are naive), AQE
    with skew-join splitting on, the Spark UI off.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the setting is absent it is set once to a folder below the warehouse
    (``spark.sql.warehouse.dir``), which driver and executors share as well.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path in the shared folder, removed by ``clear_scratch`` or at exit."""
    app = spark.sparkContext.applicationId
    if not _SCRATCH:
        atexit.register(_clear_all)
    path = f"{checkpoint_dir(spark)}/{app}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(app, []).append(path)
    return path


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint folder and
    read it back: the lineage is cut (a lost executor re-reads files instead of
    recomputing the plan) and later passes scan columnar, compressed data."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` has written. Nothing that is still to run may read them."""
    for t in tables:
        app = t.sparkSession.sparkContext.applicationId
        path = getattr(t, "_scratch_path", None)
        if path in _SCRATCH.get(app, []):
            _SCRATCH[app].remove(path)
            _delete(t.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. Call it once the results
    that read them are written; at exit it runs by itself."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _clear_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)

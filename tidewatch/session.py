"""Session construction and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app_name: str = "tidewatch", **conf: str) -> SparkSession:
    """Session with the settings every job here relies on.

    Timestamps hold UTC wall-clock time, so the session zone is UTC. Partition
    counts are left to AQE, which splits skewed join partitions and merges small
    ones; the initial count is the cluster's own setting unless given in ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone of a session built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, one-machine runs) a temporary folder stands in.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named is None and (
        spark.sparkContext.master.partition("[")[0] != "local"
    ):
        raise ValueError(f"a cluster must name a folder that all executors share in {CHECKPOINT_CONF}")
    return (named or _local_root()).rstrip("/")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidewatch-")


def shared_path(spark: SparkSession, name: str) -> str:
    """Fresh, unique location below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one intermediate result feeds several jobs. The written table
    survives the loss of executors, unlike cached blocks.
    """
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._materialized = path
    return saved


def drop_materialized(*saved: DataFrame) -> None:
    """Delete stored steps that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._materialized)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

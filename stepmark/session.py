"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "stepmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew splitting on; `conf` overrides any setting."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that the cluster names in spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="stepmark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: later plans start at the files."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by `keys`, but only where the scan has fewer than two tasks per core.

    Spark cuts a small table into about one task per core, of which only those that hold the
    start of a row group have rows. A table of more than two splits per core is left as it is.
    """
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *keys)

"""Writes: sharded tables, published versions, and the check after a write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of a version's manifest; scans leave out names that begin so.
MANIFEST = "_manifest"


def write_sharded(df: DataFrame, path: str, shards: int | None = None) -> None:
    """Save as Parquet; `shards` sets the number of files at the price of one shuffle.

    Without it each task writes its own file, which is the right choice for a large table.
    An existing table is never overwritten.
    """
    out = df if shards is None else df.repartition(shards)
    out.write.mode("errorifexists").parquet(path)


def publish_version(
    df: DataFrame, root: str, name: str, version: str, key: str, by: tuple[str, ...] = ("split",)
) -> DataFrame:
    """Save `df` under its name and version, one folder per split, with a manifest.

    `by` names the partition columns, such as ("config", "split"). The manifest has one row per
    split (rows, smallest and largest key, schema) and is taken from the files as written.

    Data and manifest are written to a folder of this attempt, which scans do not see, and become
    the version by one rename of that folder. Whatever fails before leaves no version, and the
    same version can be published again; what fails at the rename raises. A version that is there
    is never written again. (The rename is atomic on file systems that have one; on an object
    store without, a version counts once its `_manifest` is there.)
    """
    spark = df.sparkSession
    home = f"{root.rstrip('/')}/{name}"
    path, staged = f"{home}/v={version}", f"{home}/_staged/v={version}-{uuid.uuid4().hex}"
    files = _Renaming(spark, home)
    if files.exists(path):
        raise FileExistsError(f"published already: {path}")
    df.write.mode("errorifexists").partitionBy(*by).parquet(staged)
    manifest = (
        spark.read.schema(df.schema).parquet(staged)
        .groupBy(*by)
        .agg(
            F.count("*").alias("num_rows"),
            F.min(key).alias("min_key"),
            F.max(key).alias("max_key"),
        )
        .withColumn("schema_json", F.lit(df.schema.json()))
        .withColumn("version", F.lit(version))
    )
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{staged}/{MANIFEST}")
    files.rename(staged, path)
    return read_manifest(spark, root, name, version)


def read_manifest(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    """The manifest of a published version."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/v={version}/{MANIFEST}")


class _Renaming:
    """Renames that fail where the target exists, on the file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        path, conf = self._path(folder), spark._jsc.hadoopConfiguration()
        self.files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.getFileSystem(conf).getUri(), conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.files.util().exists(self._path(name))

    def rename(self, old: str, new: str) -> None:
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self.files.rename(self._path(old), self._path(new), none)


def verify_written(expected: DataFrame, written: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """Keys that should be in the written table and are not; strict mode raises if there is one.

    Keys are made distinct before the join, so a key with very many rows weighs no more
    than any other.
    """
    missing = expected.select(*keys).distinct().join(written.select(*keys).distinct(), keys, "left_anti")
    if strict:
        first = missing.take(1)
        if first:
            raise ValueError(f"not written: {first[0].asDict()}")
    return missing

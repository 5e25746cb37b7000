"""Reads: JSON lines, saved tables, splits, image files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmark.schemas import EXAMPLE
from stepmark.sources.files import list_files, scan_files


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType = EXAMPLE) -> DataFrame:
    """One JSON object per line, schema given; a line that does not parse ends the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_split(spark: SparkSession, root: str, split: str, **parts: str) -> DataFrame:
    """One split of a published table; `parts` are further partition columns (config, v, ...).

    All of them are folder names: the chosen folders are found level by level, and only they are
    listed and read. Other versions, however many files they have, are not looked into.
    """
    folders = partition_folders(spark, root, {**parts, "split": split})
    if not folders:
        raise FileNotFoundError(f"no split {split} of {parts or 'the table'} under {root}")
    return spark.read.option("basePath", root).parquet(*folders)


def partition_folders(spark: SparkSession, root: str, values: dict[str, str]) -> list[str]:
    """Folders `column=value` under `root` that have the given values, in any order of the columns.

    Looks into a folder only if its own name fits. Columns that are not asked for keep all their
    values. Only folder names pass through the driver, one level at a time.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    level, wanted = [root.rstrip("/")], dict(values)
    while wanted and level:
        deeper, columns = [], set()
        for folder in level:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            for child in path.getFileSystem(conf).listStatus(path):
                name = child.getPath().getName()
                if not child.isDirectory() or name.startswith(("_", ".")) or "=" not in name:
                    continue
                column, _, value = name.partition("=")
                columns.add(column)
                if column not in wanted or unquote(value) == str(wanted[column]):
                    deeper.append(f"{folder}/{name}")
        if not columns:
            raise ValueError(f"no partition columns {sorted(wanted)} under {root}")
        level, wanted = deeper, {c: v for c, v in wanted.items() if c not in columns}
    return level


def normal_path(path: Column) -> Column:
    """One spelling for a path: no `file:` scheme and single leading slash."""
    return F.regexp_replace(path, r"^file:/+", "/")


def scan_image_files(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """Files under `path` as (path, length[, content]); without content no file is opened.

    Listed and read by tasks, see `sources.files`.
    """
    return scan_files(spark, path) if content else list_files(spark, path)


def scan_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """Decoded images as (path, height, width, channels, mode, data); height is -1 if unreadable."""
    images = (
        spark.read.format("image")
        .option("recursiveFileLookup", "true")
        .option("dropInvalid", str(drop_invalid).lower())
        .load(path)
    )
    return images.select(
        normal_path(F.try_url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B")))).alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: its type and the number of rows of the table."""
    fields = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in df.schema.fields
    ]
    return (
        df.agg(F.count("*").alias("num_rows"))
        .select(F.explode(F.array(*fields)).alias("f"), "num_rows")
        .select("f.column", "f.type", "num_rows")
    )

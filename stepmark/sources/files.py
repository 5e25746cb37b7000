"""Files listed and read inside tasks: neither the listing nor the bytes pass through the driver."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmark.session import through_table

FILES_PER_TASK = 256
#: A task passes its rows on when their files have this many bytes.
READ_BYTES = 32 << 20


def open_storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path as that file system names it."""
    local = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(local) if "://" in local else (fs.LocalFileSystem(), local)


def _folders(found: list[fs.FileInfo]) -> list[fs.FileInfo]:
    """Without hidden names, as Spark's own file sources have it."""
    return [f for f in found if not f.base_name.startswith(("_", "."))]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files under `root`, hidden ones left out.

    Tasks list the folders of one level, each a call to the storage, and find those of the next;
    the driver only learns whether there is a next level. A folder is listed by one task, so
    billions of files want many folders. A root that is not there raises.
    """
    storage, place = open_storage(root.rstrip("/") or "/")
    if storage.get_file_info(place).type != fs.FileType.Directory:
        raise FileNotFoundError(f"no folder: {root}")
    prefix = "" if isinstance(storage, fs.LocalFileSystem) else root.rstrip("/")[: -len(place)]

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch["path"].to_pylist():
                here, name = open_storage(folder)
                found = _folders(here.get_file_info(fs.FileSelector(name, recursive=False)))
                sizes = [None if f.type == fs.FileType.Directory else f.size for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prefix + f.path for f in found], pa.string()), pa.array(sizes, pa.int64())], ["path", "length"]
                )

    tasks = 4 * spark.sparkContext.defaultParallelism
    level, files = spark.createDataFrame([(prefix + place,)], "path string"), []
    while not level.isEmpty():
        # A given number of partitions: listing waits on the storage, however small its table is.
        found = through_table(level.repartition(tasks, "path").mapInArrow(children, "path string, length long"), "listing")
        files.append(found.where("length is not null"))
        level = found.where("length is null").select("path")
    return reduce(DataFrame.unionByName, files)


def in_reading_tasks(df: DataFrame, ref: str, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """Rows dealt out for reading: as many tasks as their number asks for, at least one per core.

    The number is given, so that the small table of references is not gathered into few tasks.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // files_per_task))
    return df.repartition(tasks, ref)


def read_file(path: str | None) -> tuple[bytes | None, str | None]:
    """The bytes of a file, or why there are none."""
    if path is None:
        return None, "no reference"
    try:
        storage, name = open_storage(path)
        with storage.open_input_stream(name) as file:
            return file.read(), None
    except FileNotFoundError:
        return None, f"not found: {path}"
    except (OSError, pa.ArrowInvalid):
        return None, f"unreadable: {path}"


def read_files(df: DataFrame, ref: str = "path", content: str = "content", reason: str = "reason") -> DataFrame:
    """Add the bytes behind each reference, read by the task that holds the row, and why there are none.

    Equal references that follow each other are read once, so sort by reference inside the tasks
    where many rows share a file. `reason` is NULL where the bytes are there. Rows go on in
    portions of READ_BYTES; one file must fit in memory, a batch of them need not.
    """
    if clash := {content, reason} & set(df.columns):
        raise ValueError(f"columns are there already: {sorted(clash)}")
    schema = T.StructType([*df.schema.fields, T.StructField(content, T.BinaryType()), T.StructField(reason, T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, read_file(None)
        for batch in batches:
            start, size, rows = 0, 0, []

            def portion(start: int, rows: list, batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                part = batch.slice(start, len(rows))
                added = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
                return pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, content, reason])

            for path in batch[ref].to_pylist():
                if path != last:
                    last, found = path, read_file(path)
                rows.append(found)
                size += len(found[0] or b"")
                if size >= READ_BYTES:
                    yield portion(start, rows)
                    start, size, rows = start + len(rows), 0, []
            yield portion(start, rows)

    return df.mapInArrow(read, schema)


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, content) of all files under `root`; content is NULL where a file cannot be read."""
    return read_files(in_reading_tasks(list_files(spark, root), "path")).drop("reason")

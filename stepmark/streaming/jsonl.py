"""Examples as a stream of JSON lines.

An example is one line and never spans two micro-batches, so no operator here keeps state.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stepmark.operators.examples import peek_n
from stepmark.schemas import EXAMPLE

Transform = Callable[[DataFrame], DataFrame]
POLL_SECONDS = 0.2


def stream_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = EXAMPLE, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def stream_prepare(stream: DataFrame, transform: Transform, path: str, checkpoint: str) -> StreamingQuery:
    """Apply a row-local transform to all input there is and append it to a Parquet table."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_regroup(stream: DataFrame, transform: Transform, path: str, checkpoint: str) -> StreamingQuery:
    """The same for a transform that explodes and regroups or joins.

    Each micro-batch is written to its own folder with overwrite, so one that is run again
    replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_peek(stream: DataFrame, key: str, path: str, checkpoint: str, n: int = 3) -> DataFrame:
    """The first `n` rows of a stream: of each micro-batch in turn the first by key, until there are `n`.

    Stops the query then. What follows is not read: a micro-batch that comes before the stop is let
    pass without being evaluated. How many rows there are is counted from what is written, so a
    query that starts again from its checkpoint goes on where it was, and a micro-batch that is
    run again replaces its rows. Bound the files per micro-batch at the source to read little.
    """
    spark = stream.sparkSession
    done = Event()

    def rows_before(batch_id: int) -> int:
        folders = [f"{path}/batch_id={i}" for i in taken if i < batch_id]
        return spark.read.parquet(*folders).count() if folders else 0

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = n - rows_before(batch_id)
        if missing > 0:
            folder = f"{path}/batch_id={batch_id}"
            peek_n(batch, key, missing).write.mode("overwrite").parquet(folder)
            taken.add(batch_id)
            missing -= spark.read.schema(batch.schema).parquet(folder).count()
        if missing <= 0:
            done.set()

    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    storage = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in storage.listStatus(jvm_path)] if storage.exists(jvm_path) else []
    taken = {int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")}
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    while not query.awaitTermination(POLL_SECONDS):
        if done.is_set():
            query.stop()
            break
    folders = [f"{path}/batch_id={i}" for i in sorted(taken)]
    return spark.read.schema(stream.schema).parquet(*folders) if folders else spark.createDataFrame([], stream.schema)

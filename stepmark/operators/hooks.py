"""A user's functions over images and over batches, built once per Python worker."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import prod
from typing import Any, TypeVar

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Built = TypeVar("Built")
_BUILT: dict[str, Any] = {}


def per_worker(factory: Callable[[], Built]) -> Callable[[], Built]:
    """A getter to call inside tasks: what `factory` builds is kept from task to task of a worker.

    Two factories are told apart by their pickled form, so one with other parameters builds anew.
    """
    name = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def get() -> Built:
        from stepmark.operators import hooks  # the worker's own module, not a pickled copy of it

        if name not in hooks._BUILT:
            hooks._BUILT[name] = factory()
        return hooks._BUILT[name]

    return get


def image_features(
    rgb: DataFrame, factory: Callable[[], Callable[[np.ndarray], np.ndarray]], shape: tuple[int, ...], name: str = "features"
) -> DataFrame:
    """Add a tensor of a declared shape for each RGB image: a user's processor as an operator.

    `factory` builds a function from a (height, width, 3) byte array to an array of `shape`; it is
    called once per worker. The column is array<float> in row order, with its shape in the
    metadata of the column, so that readers can put the tensor together again. Another shape than
    the declared one raises. NULL where there are no pixels; pixels themselves are dropped.
    """
    build = per_worker(factory)
    kept = [f for f in rgb.schema.fields if f.name != "data"]
    tensor = T.StructField(name, T.ArrayType(T.FloatType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = build()

        def one(height: int, width: int, data: bytes | None) -> np.ndarray | None:
            if data is None:
                return None
            got = np.asarray(process(np.frombuffer(data, np.uint8).reshape(height, width, 3)), dtype=np.float32)
            if got.shape != tuple(shape):
                raise ValueError(f"declared shape {shape}, got {got.shape}")
            return got.reshape(prod(shape))

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("height", "width", "data")), strict=True)
            values = pa.array([one(*row) for row in rows], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), values], [*(f.name for f in kept), name])

    features = rgb.mapInArrow(run, T.StructType([*kept, tensor]))
    return features.withColumn(name, F.col(name).alias(name, metadata={"shape": list(shape)}))


def map_batches(
    batches: DataFrame, factory: Callable[[], Callable[[dict[str, Any]], dict[str, Any]]], schema: str | T.StructType
) -> DataFrame:
    """A user's function over collated batches: one row (keys, input_ids, labels, images, ...) as a
    dict in, one dict with the fields of `schema` out.

    `factory` builds the function once per worker, so it may load what it needs. Batches stay where
    they are; one at a time is in Python.
    """
    build = per_worker(factory)
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = pa.schema([(f.name, _arrow_type(f.dataType)) for f in fields])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = build()
        for part in parts:
            for at in range(part.num_rows):
                (row,) = part.slice(at, 1).to_pylist()
                yield pa.RecordBatch.from_pylist([process(row)], schema=out)

    return batches.mapInArrow(run, fields)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)

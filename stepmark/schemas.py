"""Fixed schemas. A key missing in the input is NULL in the table."""

from __future__ import annotations

from pyspark.sql import types as T

IGNORED = -100  # label of a position that does not count in the loss; part of the output contract

ITEM = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("index", T.IntegerType()),
])
MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.ArrayType(ITEM)),
])
MESSAGES = T.ArrayType(MESSAGE)
EXAMPLE = T.StructType([
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("messages", MESSAGES),
])
CONVERTED = T.StructType([
    T.StructField("image", T.StringType()),
    T.StructField("messages", MESSAGES),
])
VOCAB = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("token_id", T.IntegerType()),
])
RUN_LOG = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("step", T.LongType(), False),
    T.StructField("ts", T.TimestampType()),
    T.StructField("loss", T.DoubleType()),
])

"""Rows that a stage cannot use, in one uniform table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rejects(df: DataFrame, key: Column, stage: str, reason: Column) -> DataFrame:
    """(example_key, stage, reason) for the rows where `reason` is not NULL."""
    return df.select(
        key.cast("string").alias("example_key"), F.lit(stage).alias("stage"), reason.alias("reason")
    ).where(F.col("reason").isNotNull())


def reject_table(*parts: DataFrame, strict: bool = False) -> DataFrame:
    """All rejects of a run; strict mode raises if there is one, naming it."""
    table = reduce(DataFrame.unionByName, parts)
    if strict:
        first = table.take(1)
        if first:
            raise ValueError(f"rejected: {first[0].asDict()}")
    return table


def reference_reason(ref: Column, kind: Column) -> Column:
    """Why a reference cannot be read from storage; NULL if it can."""
    return (
        F.when(ref.isNull(), "no reference")
        .when(kind == "http", F.concat(F.lit("remote reference: "), ref))
        .when(kind == "unrecognized", F.concat(F.lit("unrecognized reference: "), ref))
    )

"""Exact row numbers without one task per table or per group."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepmark.session import through_table


def number_by_blocks(
    df: DataFrame,
    group: list[str],
    block: str,
    order: list[str],
    name: str,
    few_blocks: bool = False,
    bounds: tuple[str, str] | None = None,
) -> DataFrame:
    """Row number from 0 within `group` in the order (block, order), as column `name`.

    Rows are numbered inside each block, and each block is moved up by the number of rows in
    the blocks before it. So a task sorts one block, never a whole group, and only the block
    counts (one row each) are summed per group. `block` must follow `order` (all rows of a
    block before all rows of the next). NULL is a group like any other, and a NULL block comes
    first: no row is lost.
    `few_blocks` says that the number of blocks is bounded by construction; the counts are
    then broadcast. `bounds` names two more columns: the number of the first row of the block, and
    the one after its last.
    """
    cells = [*group, block]
    counts = df.groupBy(*cells).agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(*group).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    starts = counts.select(*[F.col(c).alias(f"_of_{c}") for c in cells], "_rows", before)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cells])
    if few_blocks:
        starts = F.broadcast(starts)
    inside = F.row_number().over(W.partitionBy(*cells).orderBy(*order))
    return (
        df.withColumn("_inside", inside)
        .join(starts, same)
        .withColumn(name, F.col("_start") + F.col("_inside") - 1)
        .withColumns({bounds[0]: F.col("_start"), bounds[1]: F.col("_start") + F.col("_rows")} if bounds else {})
        .drop("_inside", "_start", "_rows", *[f"_of_{c}" for c in cells])
    )


def number_by_ranges(df: DataFrame, order: list[Column], name: str, group: tuple[str, ...] = ()) -> DataFrame:
    """Row number from 0 in `order` within `group` (without, over the whole of `df`), as column
    `name`, for an order that has no natural block.

    Rows are dealt out by ranges of the order and written with the number of their range, so that
    a task that runs again cannot draw the ranges anew. Each range is numbered by itself and moved
    up by the rows of its group before it; only one count per range and group meets. A group with a
    third of all rows is a third of the ranges. NULL is a group like any other. Rows that tie are
    numbered in any order, so give one that has no ties.
    """
    ranges = df.repartitionByRange(*[F.col(c) for c in group], *order)
    dealt = through_table(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    cells = [*group, "_range"]
    earlier = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy(*cells).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    starts = counts.select(*[F.col(c).alias(f"_of_{c}") for c in cells], before)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cells])
    inside = F.row_number().over(W.partitionBy(*cells).orderBy(*order)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(starts, same)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_range", "_inside", "_start", *[f"_of_{c}" for c in cells])
    )

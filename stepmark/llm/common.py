"""Helpers that several operators share: clash-free columns, ranks, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from stepmark.session import shared_path, through_table  # noqa: F401  (for the operators)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; other columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) mod `parts` is `part`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


#: The settings that say how many rows a batch has.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows per batch for what runs inside. Where whole texts are read, batches of the default
    number of rows are tens of megabytes in one array, in the reader, on the way to the worker and
    in the worker, and much of that stays with the executor afterwards."""
    usual = {name: spark.conf.get(name) for name in BATCH_ROWS}
    try:
        for name in BATCH_ROWS:
            spark.conf.set(name, str(rows))
        yield
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def bucket(key: Column, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), parts if isinstance(parts, Column) else F.lit(parts))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`df` with 0-based ranks by `order` in column `name`, without a one-task sort.

    Rows are dealt out by ranges of the order; a rank is the rank inside the range plus the
    number of rows in the ranges before it. Only one count per range meets in one task.
    """
    parts = through_table(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    counts = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select(
        "__part",
        F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    )
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn("__in", inside).join(before, "__part").withColumn(name, F.col("__in") + F.col("__before")).drop("__part", "__in", "__before")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Connected components of undirected `edges` (a long, b long): (node, component).

    `component` is the smallest node reachable. Nodes without an edge to another node are left
    out. Alternates the large-star and small-star steps: every step only links a node to the
    smallest of its neighbours, so the number of edges never grows, and a hub costs a partial
    minimum, not a list. Each round is written to the shared folder, which cuts the lineage.
    """
    links = through_table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    state = None
    for _ in range(most_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = through_table(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        links = through_table(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast(T.DecimalType(38, 0)))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def in_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The groups of rows that are already sorted by `keys`, one after the other."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        values = [rows[k].to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        for a, b in zip(np.concatenate([[0], changes[:-1]]), changes, strict=True) if len(changes) else ():
            yield tuple(v[a] for v in values), rows.iloc[a:b]
        rest = rows.iloc[changes[-1] if len(changes) else 0 :]
    if rest is not None and len(rest):
        yield tuple(rest[k].iloc[0] for k in keys), rest


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Place of the first member of each member's component, from a symmetric matrix of links."""
    n = len(linked)
    labels = np.arange(n)
    while True:
        least = np.minimum(labels, np.where(linked, labels[None, :], n).min(axis=1, initial=n))
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least

"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes from indivisible groups.

A partial partition is a tuple of piles, one per shard. Differencing takes the two partial
partitions of largest spread (largest pile less smallest), puts the largest pile of one on the
smallest of the other and so on, and repeats until one is left.

The number of groups grows with the data, so differencing runs over parcels. A group of more than
1 / (LARGE * shards) of all bytes is a parcel of its own; there are fewer than LARGE * shards of
them. All other groups go by their hash to one of BINS * shards bins on one of LEVELS levels, level
j with half the chance of level j - 1. So the number of parcels is bounded at any size of the
table, their sizes span a factor of 2**LEVELS, and the small ones even out what the large ones
leave. A small table has about one group in a bin: there it is differencing of the groups.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stepmark.llm.common import pick, through_table

SHARDS = 24
LARGE, BINS, LEVELS = 64, 16, 20
#: Bytes that a document takes besides its text.
OVERHEAD = 8


def differencing(sizes: list[int], k: int) -> list[int]:
    """The pile of each item, 0 to k - 1, by Karmarkar-Karp differencing; ties by position.

    A merge keeps for each pile of the result the two piles it is made of, so the items are
    found by walking down from the last partial partition. Nothing is recursive.
    """
    n = len(sizes)
    if n == 0:
        return []
    # One entry per partial partition: (-spread, number, pile sizes ascending less the smallest).
    # `parts[number]` says for each of these piles which pile of which two parts it holds.
    heap = [(-int(s) if k > 1 else 0, i, (0,) * (k - 1) + (int(s),)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    parts: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        (_, a, left), (_, b, right) = heapq.heappop(heap), heapq.heappop(heap)
        sums = [x + y for x, y in zip(left, reversed(right), strict=True)]
        order = sorted(range(k), key=sums.__getitem__)
        least = sums[order[0]]
        piles = tuple(sums[i] - least for i in order)
        heapq.heappush(heap, (-piles[-1], n + len(parts), piles))
        parts.append((a, b, order))
    where = {heap[0][1]: list(range(k))}
    pile = [0] * n
    for number in range(n + len(parts) - 1, -1, -1):
        shards = where.pop(number)
        if number < n:
            pile[number] = shards[k - 1]
            continue
        a, b, order = parts[number - n]
        of_left, of_right = [0] * k, [0] * k
        for place, i in enumerate(order):
            of_left[i] = of_right[k - 1 - i] = shards[place]
        where[a], where[b] = of_left, of_right
    return pile


def _parcel(digest: Column, shards: int) -> Column:
    """Level and bin of a small group, as text: both come from the digest of its text."""
    unit = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    level = F.least(F.lit(31) - F.floor(F.log2(F.greatest(unit, F.lit(1)).cast("double"))).cast("int"), F.lit(LEVELS - 1))
    place = F.pmod(F.conv(F.substring(digest, 9, 8), 16, 10).cast("long"), F.lit(BINS * shards))
    return F.concat_ws("-", level.cast("string"), place.cast("string"))


def _piles(parcels: DataFrame, shards: int) -> DataFrame:
    """(parcel, shard) from (parcel, size): at most (LARGE + BINS * LEVELS) * shards rows, one task."""

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "parcel"], ascending=[False, True])
        return pd.DataFrame({"parcel": rows["parcel"].to_numpy(), "shard": np.array(differencing(rows["size"].tolist(), shards), dtype=np.int32)})

    return parcels.groupBy().applyInPandas(deal, "parcel string, shard int")


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _plan(sizes: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """The digests of the large groups, and the shard of every parcel, from (digest, size)."""
    if shards < 1:
        raise ValueError("at least one shard")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    groups = sizes.groupBy("digest").agg(F.sum("size").alias("size"))
    is_large = F.col("size").cast("decimal(38,0)") * (LARGE * shards) > F.lit(total)
    large = through_table(groups.where(is_large).select("digest", F.lit(True).alias("large")), "large")
    parcels = _with_parcel(sizes, large, shards).groupBy("parcel").agg(F.sum("size").alias("size"))
    return large, through_table(_piles(parcels, shards), "piles")


def _with_parcel(rows: DataFrame, large: DataFrame, shards: int) -> DataFrame:
    parcel = F.when(F.col("large"), F.col("digest")).otherwise(_parcel(F.col("digest"), shards))
    return rows.join(F.broadcast(large), "digest", "left").withColumn("parcel", parcel).drop("large")


def _sizes(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit("")).cast("binary")) + OVERHEAD).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    `size` is the number of UTF-8 bytes of the text plus 8, `slot` counts the documents of a shard
    from 0 without gaps. Documents with equal texts are one group and go to one shard; so a shard
    can be no smaller than the largest group, and near equality holds for what can be split.

    The texts are read once and their digest, size and place written. Sizes are summed per parcel
    with partial sums, so a group of copies with a third of all rows is one number per task; the
    shards come back by a broadcast of the parcels, whose number is bounded. Slots are counted per
    shard and written partition and moved up by the partitions before.

    NULL and empty texts are one group, of size 8 each; ids may be NULL or repeat, every row counts
    by itself; an empty table gives no rows; further columns, whatever their names, play no part.
    """
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    place = F.monotonically_increasing_id()
    rows = through_table(
        pick(docs, doc_id=doc_id, text=text).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _sizes(F.col("text")).alias("size"),
            F.crc32(content).alias("text_crc32"),
            _digest(F.col("text")).alias("digest"),
            F.shiftright(place, 33).alias("part"),
            place.alias("place"),
        ),
        "sizes",
    )
    large, piles = _plan(rows.select("digest", "size"), shards)
    dealt = _with_parcel(rows, large, shards).join(F.broadcast(piles), "parcel")
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("shard", "part").orderBy("place")) - 1
    return (
        dealt.withColumn("inside", inside)
        .join(starts, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("inside")).cast("long").alias("slot"))
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text", files: int = 1, column: str = "shard") -> DataFrame:
    """The documents, all columns kept, as Parquet in one folder per shard; returns the table read back.

    `files` is the number of files a shard is spread over, by digest and place, so that a shard
    that holds a third of the table is written by as many tasks. `column` names the folders and
    must not be a column of `docs`.
    """
    if column in docs.columns:
        raise ValueError(f"{column} is a column of the documents")
    named = docs.withColumns({"__digest": _digest(F.col(f"`{text}`")), "__place": F.monotonically_increasing_id()})
    large, piles = _plan(docs.select(_digest(F.col(f"`{text}`")).alias("digest"), _sizes(F.col(f"`{text}`")).alias("size")), shards)
    large = large.withColumnsRenamed({"digest": "__digest", "large": "__large"})
    parcel = F.when(F.col("__large"), F.col("__digest")).otherwise(_parcel(F.col("__digest"), shards))
    piles = piles.select(F.col("parcel").alias("__parcel"), F.col("shard").alias(column))
    dealt = named.join(F.broadcast(large), "__digest", "left").withColumn("__parcel", parcel).join(F.broadcast(piles), "__parcel")
    spread = dealt.repartition(shards * files, column, F.pmod(F.xxhash64("__digest", "__place"), F.lit(files)))
    spread.select(*docs.columns, column).write.mode("errorifexists").partitionBy(column).parquet(folder)
    return docs.sparkSession.read.schema(spread.select(*docs.columns, column).schema).parquet(folder)

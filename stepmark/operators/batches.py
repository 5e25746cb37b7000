"""Mixing, splitting, ordering and batching of examples.

All pseudo-random choices hash the row key with a seed, so they do not depend on how the table
is partitioned and come out the same when a task is run again. Keys must be unique; for rows
without a key see `example_key`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepmark.operators.numbering import number_by_blocks
from stepmark.schemas import IGNORED

# Seed, and the batch geometry.
SEED = 42
MICRO_BATCH = 2
ACCUMULATION = 32
DEVICES = 8

PREFIX_DIGITS = 4  # hex digits of the hash that name a numbering block: 65,536 blocks


def seeded_hash(*parts: Column | int) -> Column:
    """md5 of the parts joined by `-`."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("-", *columns))


def hash_fraction(*parts: Column | int) -> Column:
    """The first 32 bits of the hash as a fraction in [0, 1)."""
    prefix = F.conv(F.substring(seeded_hash(*parts), 1, 8), 16, 10).cast("bigint")
    return prefix / F.lit(float(2**32))


def dataset_mix(parts: dict[str, tuple[DataFrame, str, float]], seed: int = SEED) -> DataFrame:
    """Union of named datasets, each (table, key, fraction); 1.0 keeps all rows.

    A row is kept if the hash of its name and key is below the fraction.
    """

    def taken(name: str, df: DataFrame, key: str, fraction: float) -> DataFrame:
        if fraction < 1.0:
            df = df.where(hash_fraction(F.lit(name), F.col(key), seed) < fraction)
        return df.withColumn("dataset", F.lit(name))

    return reduce(DataFrame.unionByName, [taken(name, *part) for name, part in parts.items()])


def split_train_test(df: DataFrame, key: str, test_fraction: float, seed: int = SEED) -> DataFrame:
    """Add `split`: test if the hash of the key is below the fraction, else train."""
    in_test = hash_fraction(F.col(key), seed) < test_fraction
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, with the column `epoch` from 0."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def seeded_shuffle(df: DataFrame, key: str, seed: int = SEED, epoch: Column | int = 0) -> DataFrame:
    """Rows in the order of their hash for this seed and epoch: a range exchange and local sorts."""
    by_epoch = [epoch] if isinstance(epoch, Column) else []
    return df.orderBy(*by_epoch, seeded_hash(F.col(key), seed, epoch), key)


def global_index(
    df: DataFrame, key: str, seed: int = SEED, epoch: str | int = 0, digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Add `idx`, the place of each row in `seeded_shuffle` order, from 0 (per epoch column).

    A hash prefix names the block of a row; see `number_by_blocks`.
    """
    group = [epoch] if isinstance(epoch, str) else []
    epoch_value = F.col(epoch) if isinstance(epoch, str) else epoch
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed, epoch_value))
    blocked = hashed.withColumn("_block", F.substring("_hash", 1, digits))
    numbered = number_by_blocks(blocked, group, "_block", ["_hash", key], "idx", few_blocks=True)
    return numbered.drop("_hash", "_block")


@dataclass(frozen=True)
class BatchPlan:
    """Examples per device and step are micro_batch x accumulation."""

    micro_batch: int = MICRO_BATCH
    accumulation: int = ACCUMULATION
    devices: int = DEVICES

    @property
    def global_batch(self) -> int:
        return self.micro_batch * self.accumulation * self.devices


def assign_batch(df: DataFrame, plan: BatchPlan = BatchPlan(), idx: str = "idx") -> DataFrame:
    """Add step, slot (accumulation), device, position, and micro_batch, the number of the batch.

    Consecutive micro-batches go round the devices, then to the next slot, then the next step.
    """
    i = F.col(idx)
    batch = F.floor(i / plan.micro_batch)
    return df.select(
        "*",
        batch.alias("micro_batch"),
        F.floor(i / plan.global_batch).alias("step"),
        F.pmod(F.floor(batch / plan.devices), F.lit(plan.accumulation)).cast("int").alias("slot"),
        F.pmod(batch, F.lit(plan.devices)).cast("int").alias("device"),
        F.pmod(i, F.lit(plan.micro_batch)).cast("int").alias("position"),
    )


def limit_steps(df: DataFrame, max_steps: int) -> DataFrame:
    """Only the steps below `max_steps`; -1 keeps all. A filter, so it stays parallel."""
    return df if max_steps < 0 else df.where(F.col("step") < max_steps)


def group_by_length(df: DataFrame, length: str, key: str, block_rows: int, seed: int = SEED) -> DataFrame:
    """Renumber `idx` so that neighbours have similar length.

    Blocks of `block_rows` examples in index order are sorted by length, longest first, ties by
    hash. Each block is one bounded sort.
    """
    block = F.floor(F.col("idx") / block_rows)
    order = W.partitionBy("_block").orderBy(F.desc(length), seeded_hash(F.col(key), seed), key)
    return (
        df.withColumn("_block", block)
        .withColumn("idx", F.col("_block") * block_rows + F.row_number().over(order) - 1)
        .drop("_block")
    )


def _padded(values: Column, length: Column, fill: int, side: str) -> Column:
    padding = F.array_repeat(F.lit(fill).cast("int"), length - F.size(values))
    return F.concat(padding, values) if side == "left" else F.concat(values, padding)


def pad_to_longest(
    df: DataFrame,
    pad_id: int,
    batch: str | list[str] = "micro_batch",
    ids: str = "ids",
    labels: str | None = None,
    side: str = "right",
) -> DataFrame:
    """Pad ids with `pad_id` to the longest ids of the batch.

    Labels are best derived from the padded ids, so that only ids are shuffled. Where they
    exist already, name them to have them padded with the ignored mark.
    """
    longest = F.max(F.size(ids)).over(W.partitionBy(batch))
    padded = df.withColumn("_longest", longest)
    if labels is not None:
        padded = padded.withColumn(labels, _padded(F.col(labels), F.col("_longest"), IGNORED, side))
    return padded.withColumn(ids, _padded(F.col(ids), F.col("_longest"), pad_id, side)).drop("_longest")


def batch_collate(
    df: DataFrame,
    batch: str | list[str] = "micro_batch",
    position: str = "position",
    ids: str = "ids",
    labels: str = "labels",
    key: str | None = None,
    images: str | None = None,
) -> DataFrame:
    """One row per batch: input_ids and labels as lists of rows, in position order.

    With `key` there is the list `keys` too, with `images` (an array of references) the list of
    each row's references. References travel with the ids; the bytes behind them are read
    after batching, see `attach_media`. A row without images has an empty list, NULL or not.

    A batch has as many rows as the batch plan says, so the group is bounded. After
    `pad_to_longest` the rows already lie together and are not shuffled again.
    """
    fields = [F.col(position).alias("position"), F.col(ids).alias("input_ids"), F.col(labels).alias("labels")]
    if key is not None:
        fields.append(F.col(key).alias("keys"))
    if images is not None:
        fields.append(F.coalesce(F.col(images), F.array().cast("array<string>")).alias("images"))
    names = [*(["keys"] if key is not None else []), "input_ids", "labels", *(["images"] if images is not None else [])]
    rows = F.sort_array(F.collect_list(F.struct(*fields)))  # by position, which no two rows share
    by = [batch] if isinstance(batch, str) else batch
    return df.groupBy(*by).agg(rows.alias("rows")).select(*by, *[F.col(f"rows.{n}").alias(n) for n in names])


def collated_batches(
    df: DataFrame,
    key: str,
    pad_id: int,
    label: Callable[[Column], Column],
    plan: BatchPlan = BatchPlan(),
    images: str | None = None,
    seed: int = SEED,
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """`global_index`, `assign_batch`, `pad_to_longest`, `label` of the padded ids, and `batch_collate`
    with one exchange of the ids.

    Ids are dealt out by the hash prefix that names the numbering block, and a batch whose rows all
    lie in one block is padded and collated where they are. Only the rows of batches that lie
    across two blocks, fewer than two batches per block, are shuffled again. The batches are those
    of the operators one by one.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed, 0)).withColumn("_block", F.substring("_hash", 1, digits))
    numbered = number_by_blocks(hashed, [], "_block", ["_hash", key], "idx", few_blocks=True, bounds=("_first", "_end"))
    rows = assign_batch(numbered, plan)
    start = F.col("micro_batch") * plan.micro_batch
    inside = (start >= F.col("_first")) & (start + plan.micro_batch <= F.col("_end"))

    def collated(part: DataFrame, batch: list[str]) -> DataFrame:
        padded = pad_to_longest(part, pad_id, batch).withColumn("labels", label(F.col("ids")))
        return batch_collate(padded, batch, key=key, images=images).drop("_block")

    return collated(rows.where(inside), ["_block", "micro_batch"]).unionByName(collated(rows.where(~inside), ["micro_batch"]))

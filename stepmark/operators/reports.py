"""What is supervised in encoded examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.functions.labels import label_count, pad_conflict_count, supervised_count, token_hits
from stepmark.operators.tokens import vocab_reverse_lookup
from stepmark.schemas import IGNORED


def good_bad_count(df: DataFrame, good_id: int, bad_id: int, labels: str = "labels") -> DataFrame:
    """Add n_good and n_bad, the counting good and bad marks of each example."""
    return df.withColumns({
        "n_good": label_count(F.col(labels), good_id),
        "n_bad": label_count(F.col(labels), bad_id),
    })


def with_supervised_count(df: DataFrame, labels: str = "labels") -> DataFrame:
    return df.withColumn("n_supervised", supervised_count(F.col(labels)))


def with_pad_conflicts(df: DataFrame, pad_id: int, ids: str = "ids", labels: str = "labels") -> DataFrame:
    return df.withColumn("n_conflicts", pad_conflict_count(F.col(ids), F.col(labels), pad_id))


def no_supervision_examples(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Examples in which no token counts."""
    return df.where(~F.exists(labels, lambda x: x != IGNORED))


def token_status(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    good_id: int,
    bad_id: int,
    ids: str = "ids",
    labels: str = "labels",
    block: str | None = None,
) -> DataFrame:
    """One row per position: id, label, token text and status. The first status that fits holds.

    `block`, here and below, names the blocks that the rows already lie in, see `tokens.in_blocks`.
    """
    columns = [key, ids, labels] if block is None else [key, block, ids, labels]
    listed = vocab_reverse_lookup(df.select(*columns), vocab, key, ids, "_tokens", block)
    positions = listed.select(
        key,
        F.posexplode_outer(
            F.arrays_zip(
                F.col(ids).alias("token_id"), F.col(labels).alias("label"), F.col("_tokens").alias("token")
            )
        ).alias("pos", "t"),
    ).where(F.col("pos").isNotNull()).select(key, "pos", "t.token_id", "t.label", "t.token")
    status = (
        F.when(F.col("label") == IGNORED, "MASKED")
        .when(F.col("token_id") == good_id, "GOOD_TOKEN")
        .when(F.col("token_id") == bad_id, "BAD_TOKEN")
        .otherwise("UNMASKED")
    )
    return positions.withColumn("status", status)


def supervised_text(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    ids: str = "ids",
    labels: str = "labels",
    separator: str = " ",
    block: str | None = None,
) -> DataFrame:
    """Add supervised_ids, the ids that count, and supervised_text, their tokens joined."""
    pairs = F.filter(
        F.arrays_zip(F.col(ids).alias("id"), F.col(labels).alias("label")), lambda p: p["label"] != IGNORED
    )
    counting = df.withColumn("supervised_ids", pairs.getField("id"))
    texts = vocab_reverse_lookup(counting, vocab, key, "supervised_ids", "_tokens", block)
    return texts.withColumn("supervised_text", F.array_join("_tokens", separator)).drop("_tokens")


def decoded_text(
    df: DataFrame, vocab: DataFrame, key: str, ids: str = "ids", separator: str = " ", block: str | None = None
) -> DataFrame:
    """Add decoded_text, all tokens of the example joined."""
    texts = vocab_reverse_lookup(df, vocab, key, ids, "_tokens", block)
    return texts.withColumn("decoded_text", F.array_join("_tokens", separator)).drop("_tokens")


def token_accuracy(df: DataFrame, predicted: str = "predicted", labels: str = "labels") -> DataFrame:
    """Share of counting positions predicted correctly, over all rows; NULL if none counts."""
    totals = df.agg(
        F.sum(token_hits(F.col(predicted), F.col(labels))).alias("hits"),
        F.sum(supervised_count(F.col(labels))).alias("supervised"),
    )
    return totals.withColumn("token_accuracy", F.try_divide("hits", "supervised"))

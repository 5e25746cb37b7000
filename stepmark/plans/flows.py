"""The operators put together: conversion, training batches, index-resolved batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.functions import labels as L
from stepmark.functions.refs import rewrite_prefix
from stepmark.functions.sizes import CONVERSION, PixelBounds
from stepmark.functions.text import tokenize_text
from stepmark.operators import batches as B
from stepmark.operators import examples as X
from stepmark.operators import images as I
from stepmark.operators import messages as M
from stepmark.operators import tokens as T
from stepmark.operators.joins import salted_left_join
from stepmark.operators.rejects import reject_table, rejects
from stepmark.session import through_table
from stepmark.sources.writers import verify_written


def converted_table(raw: DataFrame, listing: DataFrame, prefix: str, base: str) -> DataFrame:
    """Raw examples to (image, messages, split), one row per image; a missing image raises."""
    local = raw.withColumn("images", rewrite_prefix(F.col("images"), prefix, base))
    I.missing_images_strict(local, listing)
    return X.tag_split(X.project_example(X.explode_images(local)))


@dataclass(frozen=True)
class Resized:
    """Examples (key, image, messages, split), the resized images, and (example_key, stage, reason)."""

    examples: DataFrame
    images: DataFrame
    rejects: DataFrame


def resized_table(
    raw: DataFrame,
    key: str,
    prefix: str,
    base: str,
    decoder: Callable[[], Callable[[bytes], np.ndarray]] = I.netpbm_decoder,
    suffix: str = "resized",
    bounds: PixelBounds = CONVERSION,
    strict: bool = True,
) -> Resized:
    """Raw examples to examples with their last image at its resized path, and those images.

    Only images that an example picked are opened, each once, by tasks. Their pixels and the
    outcome of each are written once, and the examples are split by it into good ones and rejects:
    no image, file not found, unreadable or not an image, sides that cannot be planned. Strict mode
    raises on the first reject, and where a good example's image is not among those written.
    """
    local = raw.withColumn("images", rewrite_prefix(F.col("images"), prefix, base))
    picked = X.last_image(local)
    paths = picked.select(F.col("image").alias("path")).where("path is not null").distinct()
    outcome = through_table(I.resized_files(paths, decoder, suffix, bounds), "resized")
    known = outcome.select(F.col("path").alias("image"), "derived_path", "reason")
    joined = through_table(salted_left_join(picked, known, "image", [key]), "picked")
    reason = F.when(F.col("image").isNull(), "no image").otherwise(F.col("reason"))
    rejected = rejects(joined, F.col(key), "image", reason)
    good = joined.where(reason.isNull()).select(key, F.col("derived_path").alias("image"), "messages")
    images = outcome.where("reason is null").drop("reason")
    if strict:
        reject_table(rejected, strict=True)
        verify_written(good.select(F.col("image").alias("derived_path")), images, ["derived_path"])
    return Resized(X.tag_split(good), images, rejected)


def rendered_text(df: DataFrame, template: M.ChatTemplate = M.ChatTemplate()) -> DataFrame:
    """Cleaned, rendered and split into tokens."""
    messages = M.drop_empty_messages(M.clean_items_media_first(F.col("messages")))
    return df.withColumn("tokens", tokenize_text(M.render_chat(messages, template))).drop("messages")


def _check_special(vocab: DataFrame, expected: dict[str, int] | None, pad_id: int, keep: list[int]) -> None:
    """Raise where a special token has not the id it should have, or padding would be supervised."""
    if pad_id in keep:
        raise ValueError(f"padding id {pad_id} is among the ids that count")
    if expected:
        T.check_token_ids(vocab, expected, pad_id, strict=True)


def training_batches(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    keep: list[int],
    pad_id: int,
    plan: B.BatchPlan = B.BatchPlan(),
    images: str | None = None,
    expected: dict[str, int] | None = None,
) -> DataFrame:
    """Examples to padded batches (keys, input_ids, labels[, images]) in which only the `keep` ids count.

    `images` names the array of references to carry along. `expected` holds the ids that special
    tokens must have; a token with another id raises, as does padding that would count.
    """
    _check_special(vocab, expected, pad_id, keep)
    carried = [key] if images is None else [key, images]
    encoded = T.vocab_lookup(rendered_text(df), vocab, key).select(*carried, "ids")
    return B.collated_batches(encoded, key, pad_id, lambda ids: L.mask_keep(ids, keep), plan, images)


def indexed_batches(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    drop: list[int],
    pad_id: int,
    plan: B.BatchPlan = B.BatchPlan(),
    expected: dict[str, int] | None = None,
) -> DataFrame:
    """The variant for image items that point into a list: everything counts but the `drop` ids.

    The images of a row are those its messages show, in their order.
    """
    _check_special(vocab, expected, pad_id, [])
    resolved = df.withColumn("messages", M.resolve_image_index(F.col("messages"), F.col("images")))
    tokens = resolved.select(
        key,
        M.flatten_message_images(F.col("messages")).alias("images"),
        tokenize_text(M.render_chat(F.col("messages"), strip=True)).alias("tokens"),
    )
    encoded = T.vocab_lookup(tokens, vocab, key).select(key, "images", "ids")
    return B.collated_batches(encoded, key, pad_id, lambda ids: L.mask_drop(ids, [*drop, pad_id]), plan, "images")

"""Label masks over token ids, and what can be counted from one row of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepmark.schemas import IGNORED


def mask_keep(ids: Column, keep: list[int]) -> Column:
    """Labels where only the `keep` ids count. By id, not by role: a mark in any message counts."""
    return F.transform(ids, lambda x: F.when(x.isin(*keep), x).otherwise(F.lit(IGNORED)))


def mask_drop(ids: Column, drop: list[int]) -> Column:
    """Labels where all ids count but the `drop` ones (padding, image marks)."""
    return F.transform(ids, lambda x: F.when(x.isin(*drop), F.lit(IGNORED)).otherwise(x))


def _count(values: Column, predicate) -> Column:
    return F.size(F.filter(values, predicate)).cast("bigint")


def supervised_count(labels: Column) -> Column:
    return _count(labels, lambda x: x != IGNORED)


def label_count(labels: Column, token_id: int) -> Column:
    return _count(labels, lambda x: x == token_id)


def pad_conflict_count(ids: Column, labels: Column, pad_id: int) -> Column:
    """Positions that are padding and yet count."""
    pairs = F.zip_with(ids, labels, lambda i, l: (i == pad_id) & (l != IGNORED))
    return _count(pairs, lambda conflict: conflict)


def token_hits(predicted: Column, labels: Column) -> Column:
    """Counting positions that were predicted correctly."""
    return _count(F.zip_with(predicted, labels, lambda p, l: (l != IGNORED) & (p == l)), lambda hit: hit)


def truncate_right(ids: Column, length: int) -> Column:
    """The first `length` tokens."""
    return F.slice(ids, 1, length)

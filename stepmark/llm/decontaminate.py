"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm import shingles
from stepmark.llm.common import bucket, pick, through_table

#: Fingerprint bits, Hamming radius, and blocks of the index. Two windows with similarity 0.8 differ
#: in 19.4 of 128 bits on average (standard deviation 4.1); closer ones in fewer.
BITS, RADIUS, BLOCKS = 128, 34, 8
BLOCK_BITS = BITS // BLOCKS
#: Items and bytes of item text in one broadcast index; more items take more passes over the documents.
ITEMS, ITEM_BYTES = 20_000, 1 << 25
TEXTS, SPAN = 128, 4096
MATCH = "struct<item_id:bigint,similarity:double,start_word:bigint,n_words:bigint>"


def _set_bits(n: int) -> np.ndarray:
    values = np.arange(1 << n, dtype=np.uint32)
    return sum((values >> np.uint32(i)) & np.uint32(1) for i in range(n)).astype(np.uint8)


SET_BITS = _set_bits(BLOCK_BITS)


def bit_signs(grams: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 per n-gram, from 128 bits of its hash."""
    both = np.stack([grams, shingles.mixed(grams ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    return np.unpackbits(np.ascontiguousarray(both).view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def window_prints(grams: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of `width` n-grams at `starts` (sorted), as 8 blocks of 16 bits."""
    out = np.zeros((len(starts), BLOCKS), dtype=np.uint16)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(starts, starts[at] + SPAN, side="right"))
        first = int(starts[at])
        signs = bit_signs(grams[first : int(starts[to - 1]) + width])
        sums = np.concatenate([np.zeros((1, BITS), dtype=np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
        here = starts[at:to] - first
        positive = (sums[here + width] - sums[here]) > 0
        out[at:to] = np.packbits(positive, axis=1).view(np.uint16)
        at = to
    return out


class MultiIndex:
    """Fingerprints bucketed by each of their blocks.

    Two fingerprints within the radius differ in at most RADIUS // BLOCKS bits in some block, so
    looking at the buckets that near in every block misses none.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.buckets = [np.unique(prints[:, b], return_inverse=True) for b in range(BLOCKS)]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) pairs within the radius."""
        rows, items = [], []
        step = max(1, (1 << 20) // max(1, len(self.prints)))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            found = np.zeros((len(part), len(self.prints)), dtype=bool)
            for b, (values, place) in enumerate(self.buckets):
                close = SET_BITS[part[:, b][:, None] ^ values[None, :]] <= RADIUS // BLOCKS
                found |= close[:, place]
            q, i = np.nonzero(found)
            apart = SET_BITS[part[q] ^ self.prints[i]].sum(axis=1, dtype=np.int64)
            rows.append(q[apart <= RADIUS] + at)
            items.append(i[apart <= RADIUS])
        return np.concatenate(rows), np.concatenate(items)


@dataclass(frozen=True)
class Items:
    ids: list[int]
    grams: list[np.ndarray]
    known: np.ndarray  # all n-grams of the items, sorted
    table: np.ndarray  # whether some known n-gram has these leading bits
    by_size: dict[int, tuple[np.ndarray, MultiIndex]]  # n-grams of an item -> its items

    @staticmethod
    def of(ids: list[int], texts: list[str | None]) -> Items:
        grams = [g if at >= shingles.WIDTH else g[:0] for g, at in _with_lengths(texts)]
        known = np.unique(np.concatenate([*grams, np.zeros(0, dtype=np.uint64)]))
        table = np.zeros(1 << 22, dtype=bool)
        table[known >> np.uint64(42)] = True
        sizes = np.array([len(g) for g in grams])
        by_size = {}
        for size in sorted({int(s) for s in sizes if s}):
            of_size = np.flatnonzero(sizes == size)
            prints = np.concatenate([window_prints(grams[i], np.zeros(1, dtype=np.int64), size) for i in of_size])
            by_size[size] = (of_size, MultiIndex(prints))
        return Items(ids, grams, known, table, by_size)

    def hits(self, grams: np.ndarray) -> np.ndarray:
        hit = self.table[grams >> np.uint64(42)]
        maybe = np.flatnonzero(hit)
        place = np.minimum(np.searchsorted(self.known, grams[maybe]), max(0, len(self.known) - 1))
        hit[maybe] = self.known[place] == grams[maybe] if len(self.known) else False
        return hit

    def matches(self, grams: np.ndarray, threshold: float) -> list[dict]:
        """Best window of each item in one document."""
        hit = self.hits(grams)
        if not hit.any():
            return []
        seen = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[float, int, int]] = {}
        for size, (items, index) in self.by_size.items():
            width = min(size, len(grams))
            # a window of that similarity shares at least this many n-grams with the item
            least = math.ceil(threshold / (1 + threshold) * (size + width) - 1e-9)
            if least > width:
                continue
            starts = np.flatnonzero(seen[width:] - seen[:-width] >= least)
            if not len(starts):
                continue
            for row, i in zip(*index.near(window_prints(grams, starts, width)), strict=True):
                start, item = int(starts[row]), int(items[i])
                similarity = weighted_similarity(grams[start : start + width], self.grams[item])
                old = best.get(item)
                if similarity >= threshold - 1e-12 and (old is None or (-similarity, start) < (-old[0], old[1])):
                    best[item] = (similarity, start, width)
        return [
            {"item_id": self.ids[item], "similarity": s, "start_word": start, "n_words": width + shingles.WIDTH - 1}
            for item, (s, start, width) in sorted(best.items())
        ]


def _with_lengths(texts: list[str | None]) -> list[tuple[np.ndarray, int]]:
    _, at = shingles.words(texts)
    return list(zip(shingles.sequences(texts), np.diff(at).tolist(), strict=True))


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity: each n-gram weighs as often as it occurs."""
    _, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = (np.bincount(p, minlength=int(place.max()) + 1) for p in (place[: len(a)], place[len(a) :]))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _matcher(spark, items: Items, threshold: float):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(f"array<{MATCH}>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[list[dict]] = []
            values = texts.tolist()
            for at in range(0, len(values), TEXTS):
                for grams, n in _with_lengths(values[at : at + TEXTS]):
                    out.append(shared.value.matches(grams, threshold) if n >= shingles.WIDTH else [])
            yield pd.Series(out, dtype=object)

    return match


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.8,
    column: str = "matches",
) -> DataFrame:
    """`docs` with `column` (replaces a column of that name): the items that a text contains.

    A match is a window of as many words as the item (or a shorter whole text) whose weighted
    similarity to it over five-word n-grams is at least `threshold`; an array entry has the best
    window of an item: item_id, similarity, start_word, n_words.

    Windows that share too few n-grams with any item to reach the threshold are not fingerprinted;
    that bound is exact. Texts are searched whole, one after the other: nothing is shuffled. The
    index is built in blocks of at most 20,000 items or 32 MB, one pass over the documents each.

    NULL, empty and texts of fewer than five words match nothing, nor do such items. Items with a
    NULL id match under a NULL id; repeated items count each. Without items nothing matches.
    """
    spark = docs.sparkSession
    docs = docs.drop(column) if column in docs.columns else docs
    items = pick(benchmark, item_id=item_id, text=item_text).where("text is not null")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(count / ITEMS), math.ceil(size / ITEM_BYTES))
    if blocks > 1:
        items = through_table(items, "items")
    found = None
    for block in range(blocks):
        part = items.where(bucket(F.col("text"), blocks) == block) if blocks > 1 else items
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))  # bounded by the block
        match = _matcher(spark, Items.of([r["item_id"] for r in rows], [r["text"] for r in rows]), threshold)(F.col(f"`{text}`"))
        found = match if found is None else F.concat(found, match)
    return docs.withColumn(column, found)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, similarity, start_word, n_words."""
    found = with_matches(pick(docs, doc_id=doc_id, text=text), benchmark, **options)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without those that contain an item; all columns kept, whatever their names."""
    found = with_matches(docs, benchmark, column="__matches", **options)
    return found.where(F.size("__matches") == 0).drop("__matches")

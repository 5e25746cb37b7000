"""Collocation mining: frequent phrases by Misra-Gries summaries, scored by their weakest cut.

Three reads of the texts, in tasks that work on slices of a few megabytes:

1. Words are counted in BUCKETS hash buckets. A word of a frequent phrase is frequent, so phrases
   with a word in a light bucket need no further look. The buckets are a filter of fixed size that
   lets through too much on a huge vocabulary and never too little.
2. The other phrases go, as hashes with counts, to hash partitions. Each partition is summed up
   by a Misra-Gries summary whose capacity exceeds its mass divided by the threshold: whatever
   occurs as often as the threshold survives. Summaries merge, so no partition is sorted whole.
3. Words and phrases whose hash survived (a filter of fixed size again) are counted exactly, by
   their text. What is below the threshold goes; what is above it cannot have been lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stepmark.llm.common import pick, through_table
from stepmark.llm.shingles import mixed

LONGEST = 5
#: Bits of the two filters: word buckets, and survivors.
WORD_BITS, PHRASE_BITS = 24, 26
#: Bytes of text that a task works on at a time, and hashes it sums up before they go on.
SLICE, WAITING = 4 << 20, 4 << 20
#: Phrases that a task sums up before they go on.
HELD = 400_000
#: Phrase occurrences a hash partition should have.
MASS = 4_000_000
#: Lists of the best per language are first cut down in this many parts.
PARTS = 64
#: A-Z lower, marks that end a piece to line feed, tab to space.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")


class MisraGries:
    """Counts of the heavy keys of a stream in at most `capacity` counters.

    A count is too low by at most `error` <= mass / (capacity + 1), so every key that occurs more
    often is kept. Merging adds counters and takes the (capacity + 1)-th largest count off all.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.error = 0
        self.keys = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(self.keys) > self.capacity:
            place = len(self.keys) - self.capacity - 1
            off = int(np.partition(self.counts, place)[place])
            self.error += off
            self.counts = self.counts - off
            left = self.counts > 0
            self.keys, self.counts = self.keys[left], self.counts[left]

    def merge(self, other: MisraGries) -> None:
        self.add(other.keys, other.counts)
        self.error += other.error

    def may_reach(self, threshold: int) -> np.ndarray:
        """All keys that can have occurred `threshold` times."""
        return self.keys[self.counts + self.error >= threshold]


def packed(values: np.ndarray) -> bytes:
    """64-bit values as compressed bytes: first all low bytes, then the next. Small values and
    values that share their high bytes become short."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


@dataclass
class Words:
    """The words of some texts of one language: hash, exact id and piece of each, in order."""

    names: pa.Array
    ids: np.ndarray
    hashes: np.ndarray
    pieces: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where `n` words lie in one piece, and the hash of these words."""
        at = np.flatnonzero(self.pieces[n - 1 :] == self.pieces[: len(self.pieces) - n + 1]) if len(self.ids) >= n else np.zeros(0, np.int64)
        out = self.hashes[at]
        for k in range(1, n):
            out = mixed(out ^ (self.hashes[at + k] * np.uint64(2 * k + 1)))
        return at, out


def words_of(texts: list[str | None], lang: str) -> Words:
    data = "\n".join([t or "" for t in texts]).encode().translate(FOLD)
    raw = np.frombuffer(data, np.uint8)
    is_line = raw == 10
    blank = is_line | (raw == 32)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    offsets = np.append(0, np.cumsum(stops - starts)).astype(np.int64)
    letters = np.ascontiguousarray(raw[~blank])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    hashes = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    ids = coded.indices.to_numpy()
    return Words(coded.dictionary, ids, hashes[ids], np.cumsum(is_line)[starts] if len(starts) else np.zeros(0, np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str | None]]]:
    """Texts of one language, about SLICE bytes at a time; a longer text is a slice of its own."""
    waiting: dict[str, list] = {}
    sizes: dict[str, int] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            waiting.setdefault(lang, []).append(text)
            size = len(text or "")
            sizes[lang] = sizes.get(lang, 0) + size
            held += size
            if sizes[lang] >= SLICE:
                held -= sizes.pop(lang)
                yield lang, waiting.pop(lang)
            elif held >= 4 * SLICE:  # many languages, little of each
                yield from waiting.items()
                waiting, sizes, held = {}, {}, 0
    yield from waiting.items()


def _word_buckets(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n): words per bucket of all languages (lang NULL), and words per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, total = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        per_lang: dict[str, int] = {}
        for lang, texts in _slices(batches):
            words = words_of(texts, lang)
            buckets, n = np.unique(words.hashes >> np.uint64(64 - WORD_BITS), return_counts=True)
            used, total = summed(np.concatenate([used, buckets]), np.concatenate([total, n]))
            per_lang[lang] = per_lang.get(lang, 0) + len(words.ids)
        names = pa.array([*per_lang, *[None] * len(used)], pa.string())
        buckets = np.concatenate([np.full(len(per_lang), -1, dtype=np.int64), used.astype(np.int64)])
        counts = np.concatenate([np.array([*per_lang.values()], dtype=np.int64), total])
        yield pa.RecordBatch.from_arrays([names, pa.array(buckets, pa.int64()), pa.array(counts, pa.int64())], ["lang", "bucket", "n"])

    return docs.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _filter(places: DataFrame, bits: int) -> np.ndarray:
    """A bit per place below 2**bits; the table sent to the driver has at most 2**(bits - 6) rows."""
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits"))
    table = words.toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), dtype=np.uint64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return out


def passing(filled: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (filled[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _likely(words: Words, heavy: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases of `n` words that all lie in heavy buckets."""
    at, hashes = words.grams(n)
    if not len(at):
        return at, hashes
    ok = np.append(0, np.cumsum(passing(heavy, WORD_BITS, words.hashes)))
    good = ok[at + n] - ok[at] == n
    return at[good], hashes[good]


def _survivors(docs: DataFrame, heavy: np.ndarray, threshold: int, total: int, longest: int) -> DataFrame:
    """(place): filter places of the phrases that survive the summary of their hash partition.

    There are at most `longest - 1` phrases per word. The leading bits of a hash name its partition.
    As many bits go over the wire as tell most phrases apart; those that are not are summed up
    together, so more survive, never fewer.
    """
    most = max(1, (longest - 1) * total)
    bits = max(PHRASE_BITS, min(64, most.bit_length() + 3))
    partition_bits = (most // MASS).bit_length()
    drop = np.uint64(64 - bits)

    def send(grams: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(grams) >> drop, return_counts=True)
        part = (keys >> np.uint64(bits - partition_bits)).astype(np.int64)
        used, first = np.unique(part, return_index=True)
        cuts = [*first.tolist(), len(keys)]
        parts = [(keys[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        columns = [
            pa.array(used, pa.int64()),
            pa.array([len(k) for k, _ in parts], pa.int64()),
            pa.array([packed(np.diff(k, prepend=np.uint64(0))) for k, _ in parts], pa.binary()),
            pa.array([packed(c.astype(np.uint64)) for _, c in parts], pa.binary()),
            pa.array([int(c.sum()) for _, c in parts], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "size", "steps", "counts", "mass"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = [], 0
        for lang, texts in _slices(batches):
            words = words_of(texts, lang)
            for n in range(2, longest + 1):
                grams.append(_likely(words, heavy, n)[1])
                held += len(grams[-1])
            if held >= WAITING:
                yield send(grams)
                grams, held = [], 0
        if held:
            yield send(grams)

    def sum_up(group: pd.DataFrame) -> pd.DataFrame:
        summary = MisraGries(int(group["mass"].sum()) // threshold + 1)
        for steps, counts, size in zip(group["steps"], group["counts"], group["size"], strict=True):
            summary.add(np.cumsum(unpacked(steps, size), dtype=np.uint64), unpacked(counts, size).astype(np.int64))
        places = summary.may_reach(threshold) >> np.uint64(bits - PHRASE_BITS)
        return pd.DataFrame({"place": np.unique(places).astype(np.int64)})

    dealt = docs.mapInArrow(deal, "part long, size long, steps binary, counts binary, mass long")
    return dealt.groupBy("part").applyInPandas(sum_up, "place long")


def _exact(docs: DataFrame, heavy: np.ndarray, alive: np.ndarray, threshold: int, total: int, longest: int) -> DataFrame:
    """(lang, phrase, size, f): counts by text of the words and phrases that pass the filters.

    A task sums up what it reads and sends it to hash partitions as lists; a partition has the
    distinct phrases of its hashes once per task that met them.
    """
    partition_bits = (max(1, (longest - 1) * total) // MASS).bit_length()

    def texts_of(words: Words, at: np.ndarray, n: int) -> list[str]:
        names = words.names
        parts = [names.take(pa.array(words.ids[at + k])).to_pylist() for k in range(n)]
        return [b" ".join(p).decode() for p in zip(*parts, strict=True)]

    def send(held: dict[tuple[int, str, str], int]) -> pa.RecordBatch:
        rows = pd.DataFrame([*held], columns=["part", "lang", "phrase"]).assign(f=[*held.values()]).sort_values("part")
        used, first = np.unique(rows["part"].to_numpy(), return_index=True)
        offsets = pa.array(np.append(first, len(rows)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(rows[c], t)) for c, t in (("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *lists], ["part", "lang", "phrase", "f"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str, str], int] = {}
        for lang, texts in _slices(batches):
            words = words_of(texts, lang)
            for n in range(1, longest + 1):
                at, hashes = _likely(words, heavy, n)
                if n > 1:
                    kept = passing(alive, PHRASE_BITS, hashes)
                    at, hashes = at[kept], hashes[kept]
                while len(at):
                    every, first, where, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                    # Phrases of equal hash are told apart by their words.
                    other = np.zeros(len(at), dtype=bool)
                    for k in range(n):
                        other |= words.ids[at + k] != words.ids[at[first][where] + k]
                    if other.any():
                        times = np.bincount(where[~other], minlength=len(first))
                    parts = every >> np.uint64(64 - partition_bits) if partition_bits else np.zeros(len(every), np.int64)
                    for part, phrase, f in zip(parts.tolist(), texts_of(words, at[first], n), times.tolist(), strict=True):
                        key = (part, lang, phrase)
                        held[key] = held.get(key, 0) + f
                    at, hashes = at[other], hashes[other]
            if len(held) > HELD:
                yield send(held)
                held = {}
        if held:
            yield send(held)

    def sum_up(group: pd.DataFrame) -> pd.DataFrame:
        rows = pd.DataFrame({c: np.concatenate(group[c].tolist()) for c in ("lang", "phrase", "f")})
        sums = rows.groupby(["lang", "phrase"], as_index=False)["f"].sum()
        sums = sums[sums["f"] >= threshold]
        return sums.assign(size=sums["phrase"].str.count(" ") + 1)[["lang", "phrase", "size", "f"]]

    dealt = docs.mapInArrow(count, "part long, lang array<string>, phrase array<string>, f array<long>")
    return dealt.groupBy("part").applyInPandas(sum_up, "lang string, phrase string, size int, f long")


def frequent(docs: DataFrame, threshold: int = 100, longest: int = LONGEST, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of 1 to `longest` words that occur `threshold` times
    or more in their language, and (lang, n), all words of each language. Both are exact."""
    if threshold < 1 or longest < 2:
        raise ValueError("threshold from 1 on, phrases of two words or more")
    rows = pick(docs, lang=lang, text=text).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    rows = rows.where("text is not null")
    buckets = through_table(_word_buckets(rows), "buckets")
    words = buckets.where("lang is not null").select("lang", "n")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = _filter(buckets.where(F.col("lang").isNull() & (F.col("n") >= threshold)).select(F.col("bucket").alias("place")), WORD_BITS)
    alive = _filter(_survivors(rows, heavy, threshold, total, longest), PHRASE_BITS)
    return through_table(_exact(rows, heavy, alive, threshold, total, longest), "phrases"), words


def _cut(parts: Column, k: Column, size: Column) -> tuple[Column, Column]:
    return F.concat_ws(" ", F.slice(parts, F.lit(1), k)), F.concat_ws(" ", F.slice(parts, k + 1, size - k))


def mine(
    docs: DataFrame,
    threshold: int = 100,
    longest: int = LONGEST,
    covered_percent: int = 100,
    top: int = 2000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A piece is a run of text without `.,;:!?` and line ends, a word a run of a piece without spaces and
    tabs, A-Z lower-cased. f counts all occurrences of a phrase inside pieces. A phrase of 2 to `longest` words
    with a = f >= `threshold` is a candidate; cut into two parts of f = l and r it scores
    floor(1000 * a * n / (l * r)) with n words in the language; its weakest cut counts, the first of
    equals. A candidate inside a longer one that occurs in at least `covered_percent` per cent of its
    places is dropped. Products are decimals of 38 digits, so they are exact up to 10**38.

    A NULL language is `und`, NULL and empty texts have no words, repeated rows count each, an empty
    table gives no rows, other columns play no part. Ties of score and count go by phrase in byte order.
    """
    counts, totals = frequent(docs, threshold, longest, lang, text)
    found = counts.where("size > 1").withColumnRenamed("f", "a").withColumn("parts", F.split("phrase", " "))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left, right = _cut(F.col("parts"), F.col("k"), F.col("size"))
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), right.alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    up = (wide["a"] * wide["n"]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.withColumns({"up": up.cast("decimal(38,0)"), "down": (wide["l"] * wide["r"]).cast("decimal(38,0)")})
    cuts = cuts.withColumn("score", F.expr("up div down").cast("long"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = found.where("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    spans = spans.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = F.concat_ws(" ", F.slice("parts", F.col("start"), F.col("length")))
    covers = spans.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a"))
    )
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

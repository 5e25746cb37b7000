"""Exact substring dedup by suffix arrays with two-stage sorting.

Byte strings of 50 that also start in a document of smaller id are removed. Windows that could be
repeated are found by the smallest 24-gram hash inside them; they are dealt out by that hash with
their bytes, and each task sorts its windows' suffixes and compares neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import bucket, pick, shared_path, through_table
from stepmark.llm.shingles import mixed

WINDOW, GRAM = 50, 24
SEGMENT = 1 << 16
#: Bytes of text in a block of documents, anchors that are counted together, and bytes sorted together.
BLOCK_BYTES, COUNTED, SORTED_BYTES = 1 << 22, 1 << 22, 1 << 23
#: A key with more occurrences is split by the windows themselves.
HOT = 20_000
KEY_BYTES = 5
_BASE = 0xD6E8FEB86659FD93


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each 24-gram, from hashes of 8 and 16 bytes."""
    part, length = mixed(data.astype(np.uint64) + np.uint64(1)), 1
    eight = part
    while length < 16:
        part = part[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + part[length:]
        length *= 2
        eight = part if length == 8 else eight
    n = len(data) - GRAM + 1
    return mixed(part[:n] * np.uint64(pow(_BASE, 8, 1 << 64)) + eight[16 : 16 + n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    return np.minimum(x[: len(x) - (width - length)], x[width - length :]) if length < width else x


def owners(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 50-byte window the place and hash of its smallest 24-gram (the last of equals).

    It depends on the window's bytes alone, so equal windows have the same one.
    """
    places, hashes = [], []
    low, width = np.uint64(0xFFFFFF), WINDOW - GRAM + 1
    for at in range(0, len(data) - WINDOW + 1, SEGMENT):
        h = _gram_hashes(data[at : at + SEGMENT + WINDOW - 1])
        order = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        place = (low - (_least(order, width) & low)).astype(np.int64)
        places.append(place + at)
        hashes.append(h[place])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([*places, none]), np.concatenate([*hashes, none.astype(np.uint64)])


@dataclass
class Runs:
    """Windows of the documents of a block that follow each other and have the same owner."""

    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    entry: np.ndarray  # which (key, document) pair of the block
    keys: np.ndarray  # keys of the pairs, sorted


def runs_of(data: np.ndarray, offsets: np.ndarray) -> Runs:
    place, h = owners(data)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(doc[: len(place)] == doc[WINDOW - 1 :]) if len(place) else np.zeros(0, dtype=np.int64)
    own = place[window]
    fresh = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
    start = window[fresh]
    count = np.diff(np.append(fresh, len(window)))
    key = mixed(h[start] ^ np.uint64(0xA0761D6478BD642F))
    order = np.lexsort((doc[start], key))
    k, d = key[order], doc[start][order]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]) if len(k) else np.zeros(0, dtype=bool)
    entry = np.zeros(len(k), dtype=np.int64)
    entry[order] = np.cumsum(first) - 1
    return Runs(start, count, doc[start], key, entry, k[first])


def _bytes5(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray((keys >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _from5(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFF)).astype(np.int64) % parts


def _block(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    rows = rows.drop_duplicates("node").sort_values("node", ignore_index=True)  # repeated rows lie here twice
    data = np.frombuffer(b"".join(rows["body"]), dtype=np.uint8)
    return rows, data, np.concatenate([[0], np.cumsum(rows["body"].map(len).to_numpy(dtype=np.int64))])


def _pieces(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of all elements of the slices starts[i] : starts[i] + lengths[i]."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


def sorted_windows(text: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the wanted windows in suffix order, and whether each equals the one before it.

    `text` holds bytes plus one, a 0 after each piece, and 64 zeros at the end. Two stages: only
    suffixes smaller than their successor are sorted directly, by words of eight bytes as far as
    they tie; a suffix larger than its successor follows from the successor's place when the
    buckets of first bytes are scanned in order. Neighbours share a prefix of 50 or more if their
    words agree.
    """
    n = len(text) - 64
    differs = np.flatnonzero(text[:-1] != text[1:])
    after = differs[np.minimum(np.searchsorted(differs, np.arange(n)), max(0, len(differs) - 1))]
    rising = text[after] < text[after + 1]
    member = np.zeros(len(text), dtype=bool)
    member[: len(wanted)] = wanted
    falling = np.zeros(len(text), dtype=bool)
    falling[:n] = ~rising
    todo = np.flatnonzero(member & falling)
    while len(todo):  # up to the next directly sorted suffix
        todo = todo[~member[todo + 1]] + 1
        member[todo] = True
        todo = todo[falling[todo]]
    words = np.zeros(n + 56, dtype=np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | text[i : i + n + 56].astype(np.uint64)

    place = np.flatnonzero(member & ~falling)
    place = place[np.argsort(words[place], kind="stable")]
    key = words[place]
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(place) else np.zeros(0, dtype=bool)
    for depth in range(8, WINDOW, 8):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        group = np.cumsum(fresh)[tied]
        key = words[np.minimum(place[tied] + depth, n + 55)]
        order = np.lexsort((key, group))
        place[tied] = place[tied][order]
        key = key[order]
        fresh[tied[1:]] |= key[1:] != key[:-1]

    first = text[place]
    at = np.searchsorted(first, np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    before = np.concatenate([[0], text])  # the byte before each place
    usable = np.concatenate([[False], member & falling])  # whether the suffix before is induced
    for c in range(256):
        part = np.concatenate([*pending[c], np.zeros(0, dtype=np.int64)])
        parts, last = [part], part
        while len(last):  # runs of the same byte
            last = last[usable[last] & (before[last] == c)] - 1
            parts.append(last)
        bucket_ = np.concatenate([*parts, place[at[c] : at[c + 1]]])
        if not len(bucket_):
            continue
        out.append(bucket_)
        back = bucket_[usable[bucket_] & (before[bucket_] > c)] - 1
        byte = text[back]
        order = np.argsort(byte, kind="stable")
        back, byte = back[order], byte[order]
        cuts = np.searchsorted(byte, np.arange(c + 1, 257))
        for k in np.flatnonzero(np.diff(cuts)):
            pending[c + 1 + k].append(back[cuts[k] : cuts[k + 1]])
    every = np.concatenate([*out, np.zeros(0, dtype=np.int64)])
    every = every[every < len(wanted)]
    every = every[wanted[every]]
    same = np.ones(max(0, len(every) - 1), dtype=bool)
    for depth in (0, 8, 16, 24, 32, 40, 42):
        word = words[every + depth]
        same &= word[1:] == word[:-1]
    return every, np.concatenate([[False], same])[: len(every)]


def _removed(blobs: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Intervals to remove, from all pieces of one part: rows (block, spans)."""
    count = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in blobs["counts"]]).astype(np.int64)
    where = np.concatenate([np.frombuffer(x, dtype=np.int64).reshape(-1, 3) for x in blobs["places"]])
    block = np.repeat(blobs["block"].to_numpy(), [len(x) // 4 for x in blobs["counts"]])
    data = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in blobs["body"]])
    lead = where[:, 2]
    length = count + WINDOW - 1
    start = np.cumsum(length) - length
    # equal pieces once, with the smallest id they occur in
    weight = np.cumsum(mixed(data.astype(np.uint64) + np.uint64(1)) * _powers(len(data)), dtype=np.uint64)
    weight = np.concatenate([[np.uint64(0)], weight])
    name = (weight[start + length] - weight[start]) * _powers(len(data), inverse=True)[start]
    del weight
    order = np.lexsort((lead, name, length))
    fresh = np.concatenate([[True], (name[order][1:] != name[order][:-1]) | (length[order][1:] != length[order][:-1])])
    piece = np.zeros(len(order), dtype=np.int64)
    piece[order] = np.cumsum(fresh) - 1
    first = order[fresh]
    # the text of the distinct pieces, each with a 0 behind it
    width, least = length[first], lead[first]
    at = np.cumsum(width + 1) - (width + 1)
    text = np.zeros(int((width + 1).sum()) + 64, dtype=np.uint8)
    text[_pieces(width, at)] = data[_pieces(width, start[first])] + 1
    wanted = np.zeros(len(text) - 64, dtype=bool)
    wanted[_pieces(count[first], at)] = True
    places, same = sorted_windows(text, wanted)
    owner = np.repeat(np.arange(len(first)), width + 1)
    heads = np.flatnonzero(~same)
    smallest = np.minimum.reduceat(least[owner[places]], heads) if len(heads) else np.zeros(0, dtype=np.int64)
    of_window = np.zeros(len(wanted), dtype=np.int64)
    of_window[places] = np.repeat(smallest, np.diff(np.append(heads, len(places))))
    # all windows of an occurrence go, or none, or each is looked at
    values = of_window[_pieces(count[first], at)]
    bounds = np.cumsum(count[first]) - count[first]
    lo, hi = np.minimum.reduceat(values, bounds), np.maximum.reduceat(values, bounds)
    whole = lead > hi[piece]
    mixed_ = np.flatnonzero(~whole & (lead > lo[piece]))
    spans = [np.stack([block[whole], where[whole, 0], where[whole, 1], where[whole, 1] + length[whole]], axis=1)]
    if len(mixed_):
        n = count[mixed_]
        gone = values[_pieces(n, bounds[piece[mixed_]])] < np.repeat(lead[mixed_], n)
        which = np.repeat(mixed_, n)[gone]
        offset = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))[gone]
        begin = where[which, 1] + offset
        spans.append(np.stack([block[which], where[which, 0], begin, begin + WINDOW], axis=1))
    found = np.concatenate(spans)
    found = found[np.argsort(found[:, 0], kind="stable")]
    cuts = np.flatnonzero(np.diff(found[:, 0], prepend=-1)) if len(found) else np.zeros(0, dtype=np.int64)
    for a, b in zip(cuts, np.append(cuts[1:], len(found)), strict=True) if len(cuts) else ():
        yield pd.DataFrame({"block": [found[a, 0]], "spans": [np.ascontiguousarray(found[a:b, 1:]).tobytes()]})


_POWERS: dict[bool, np.ndarray] = {}


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    held = _POWERS.get(inverse)
    if held is None or len(held) < n:
        base = np.uint64(pow(_BASE, -1, 1 << 64) if inverse else _BASE)
        held = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        held[0] = 1
        _POWERS[inverse] = held = np.cumprod(held)
    return held[:n]


def _united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)]


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes. Each byte goes that lies in a 50-byte string which also starts in a
    document with a smaller id, judged on the input; `spans` are the maximal removed runs,
    kept_sha256 is the hash of the remaining bytes. NULL counts as empty; texts under 50 bytes lose
    nothing; rows with equal ids do not remove from each other; a row with a NULL id is kept whole
    and removes nothing. An empty table gives no rows.

    Plan: equal texts become one, so copies cost a group and no sorting. The texts are laid out
    once in blocks of about 4 MB, as a bucketed table that later steps read without a shuffle.
    Each block sends five bytes per owner hash; counts come back as one bit each. Windows whose
    owner occurs in several documents go to their hash's part with their bytes. Parts are sized
    from the number of bytes, and a hash with more than 20,000 occurrences is split into its
    windows, dealt out by their own bytes. Intervals go back to the blocks.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    length = F.octet_length("body").cast("long")
    short = F.col("doc_id").isNull() | (length < WINDOW)
    listed = rows.select("doc_id", F.md5("body").alias("key"), length.alias("n_bytes"), F.when(short, F.sha2("body", 256)).alias("sha"))
    listed = through_table(listed, "listed")
    classes = listed.where((F.col("n_bytes") >= WINDOW) & F.col("doc_id").isNotNull())
    classes = classes.groupBy("key").agg(F.min("doc_id").alias("lead"), F.min("n_bytes").alias("n_bytes"))
    classes = through_table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    total = classes.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(files, total // BLOCK_BYTES)
    counted = max(1, files, total // 12 // COUNTED)
    parts = max(1, files, total // SORTED_BYTES)

    # one text of each class, laid out by block
    leads = rows.join(classes.select(F.col("lead").alias("doc_id"), "node", "key", "lead"), "doc_id").where(F.md5("body") == F.col("key"))
    layout = leads.select("node", "lead", "body", bucket(F.col("node"), blocks).alias("block"))
    path = shared_path(spark, "blocks")
    name = "suffix_blocks_" + path[-32:]
    layout = layout.repartition(files, "block").sortWithinPartitions("block", "node")
    layout.write.bucketBy(files, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    try:
        found = _spans(spark.table(name), counted, parts)
    finally:
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay for the plan
    found = found.join(classes.select("node", "key", "lead"), "node")
    out = listed.join(found, "key", "left")
    copy = F.col("doc_id") > F.col("lead")
    none = F.sha2(F.lit("").cast("binary"), 256)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.when(F.col("sha").isNotNull(), no_spans).when(copy, all_of_it).otherwise(F.col("spans"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("sha").isNotNull(), F.lit(0)).when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(F.col("sha").isNotNull(), F.col("sha")).when(copy, none).otherwise(F.col("kept")).alias("kept_sha256"),
        spans.alias("spans"),
    )


def _spans(layout: DataFrame, counted: int, parts: int) -> DataFrame:
    """(node, n_removed, n_spans, spans, kept) of each text of the layout."""

    def send(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, data, offsets = _block(rows)
        keys = runs_of(data, offsets).keys
        part = _part(keys, counted)
        order = np.argsort(part, kind="stable")
        at = np.searchsorted(part[order], np.arange(counted + 1))
        filled = np.flatnonzero(np.diff(at))
        raw = [_bytes5(keys[order[at[p] : at[p + 1]]]) for p in filled]
        return pd.DataFrame({"block": key[0], "part": filled, "keys": raw})

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sent = [_from5(r) for r in rows["keys"]]
        _, place, n = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        times = np.split(n[place], np.cumsum([len(s) for s in sent])[:-1])
        bits = lambda least: [np.packbits(t > least).tobytes() for t in times]
        return pd.DataFrame({"block": rows["block"], "part": key[0], "several": bits(1), "hot": bits(HOT)})

    sent = layout.groupBy("block").applyInPandas(send, "block long, part long, keys binary")
    flags = sent.groupBy("part").applyInPandas(count, "block long, part long, several binary, hot binary")
    flags = through_table(flags, "flags")

    def cut(key: tuple, rows: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        rows, data, offsets = _block(rows)
        runs = runs_of(data, offsets)
        part = _part(runs.keys, counted)
        order = np.argsort(part, kind="stable")
        at = np.searchsorted(part[order], np.arange(counted + 1))
        several, hot = (np.zeros(len(runs.keys), dtype=bool) for _ in range(2))
        for p, s, h in zip(bits["part"], bits["several"], bits["hot"], strict=True):
            here = order[at[p] : at[p + 1]]
            for flags_, raw in ((several, s), (hot, h)):
                flags_[here] = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))[: len(here)].astype(bool)
        plain = np.flatnonzero(several[runs.entry] & ~hot[runs.entry])
        start, n, doc = runs.start[plain], runs.count[plain], runs.doc[plain]
        to = (runs.key[plain] >> np.uint64(20)).astype(np.int64) % parts
        split = np.flatnonzero(hot[runs.entry])
        if len(split):  # single windows, by their own bytes
            single = _pieces(runs.count[split], runs.start[split])
            padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
            own = np.zeros(len(single), dtype=np.uint64)
            for depth in (0, 8, 16, 24, 32, 40, 42):
                word = np.zeros(len(single), dtype=np.uint64)
                for i in range(8):
                    word = (word << np.uint64(8)) | padded[single + depth + i].astype(np.uint64)
                own = mixed(own ^ word)
            start, n = np.concatenate([start, single]), np.concatenate([n, np.ones(len(single), dtype=n.dtype)])
            doc = np.concatenate([doc, np.repeat(runs.doc[split], runs.count[split])])
            to = np.concatenate([to, (own >> np.uint64(20)).astype(np.int64) % parts])
        order = np.argsort(to, kind="stable")
        start, n, doc, to = start[order], n[order].astype(np.int32), doc[order], to[order]
        lead = rows["lead"].to_numpy()
        places = np.stack([doc, start - offsets[doc], lead[doc]], axis=1).astype(np.int64)
        at = np.searchsorted(to, np.arange(parts + 1))
        filled = np.flatnonzero(np.diff(at))
        lengths = n.astype(np.int64) + WINDOW - 1
        slices = [slice(at[p], at[p + 1]) for p in filled]
        return pd.DataFrame(
            {
                "block": key[0],
                "part": filled,
                "counts": [n[s].tobytes() for s in slices],
                "places": [places[s].tobytes() for s in slices],
                "body": [data[_pieces(lengths[s], start[s])].tobytes() for s in slices],
            }
        )

    def sort(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = list(_removed(rows))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"block": np.zeros(0, dtype=np.int64), "spans": []})

    pieces = layout.groupBy("block").cogroup(flags.groupBy("block")).applyInPandas(
        cut, "block long, part long, counts binary, places binary, body binary"
    )
    spans = through_table(pieces.groupBy("part").applyInPandas(sort, "block long, spans binary"), "spans")

    def keep(key: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows, _, _ = _block(rows)
        every = np.concatenate([*[np.frombuffer(s, dtype=np.int64).reshape(-1, 3) for s in found["spans"]], np.zeros((0, 3), dtype=np.int64)])
        every = every[np.argsort(every[:, 0], kind="stable")]
        at = np.searchsorted(every[:, 0], np.arange(len(rows) + 1))
        runs, removed, hashes = [], [], []
        for i, raw in enumerate(rows["body"]):
            a, b = at[i], at[i + 1]
            if a == b:
                runs.append([])
                removed.append(0)
                hashes.append(hashlib.sha256(raw).hexdigest())
                continue
            starts, ends = _united(every[a:b, 1], every[a:b, 2])
            left = hashlib.sha256()
            for s, e in zip(np.append(0, ends), np.append(starts, len(raw)), strict=True):
                left.update(raw[s:e])
            runs.append([{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)])
            removed.append(int((ends - starts).sum()))
            hashes.append(left.hexdigest())
        return pd.DataFrame({"node": rows["node"], "n_removed": removed, "spans": runs, "kept": hashes})

    return through_table(
        layout.groupBy("block")
        .cogroup(spans.groupBy("block"))
        .applyInPandas(keep, "node long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept string"),
        "kept",
    )

"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm import shingles
from stepmark.llm.common import components, in_groups, local_roots, pick, small_batches, through_table

#: Share of pairs at the threshold itself that the bands must bring together.
RECALL = 0.99999
MOST_HASHES = 128
#: Members of a cluster that one task compares with as many others.
BLOCK = 1024
TEXTS, ROWS, COLUMNS = 128, 512, 8192
SEED = 20_240_501


def banding(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands that reach the recall within the number of hashes."""
    best = (1, 1)
    for rows in range(1, 33):
        share = threshold**rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-share))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of the minima of `bands * rows` permutations of the n-grams."""
    by = _multipliers(bands * rows)
    least = np.full(len(by), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 4096):
        np.minimum(least, (grams[None, at : at + 4096] * by[:, None]).min(axis=1), out=least)
    least = least.reshape(bands, rows)
    out = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        out = shingles.mixed(out ^ least[:, i])
    return out.view(np.int64)


def _key(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _fingerprints(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                part = batch.iloc[at : at + TEXTS]
                grams = list(shingles.sets(part["text"].tolist(), width))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "key": [_key(g) for g in grams],
                        "bands": [band_hashes(g, bands, rows) if len(g) else None for g in grams],
                    }
                )

    return docs.mapInPandas(compute, "doc_id long, key binary, bands array<long>")


def _with_sets(rows: DataFrame, width: int) -> DataFrame:
    """`rows` (text, key, ...) with `grams`, the set as bytes, where the text has that key."""
    columns = [f for f in rows.schema.fields if f.name not in ("text", "key")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns) + ", grams binary"

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                part = batch.iloc[at : at + TEXTS]
                grams = list(shingles.sets(part["text"].tolist(), width))
                same = [_key(g) == bytes(k) for g, k in zip(grams, part["key"], strict=True)]
                yield part.drop(columns=["text", "key"]).assign(grams=[g.tobytes() for g in grams])[same]

    return rows.mapInPandas(compute, schema)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of presence matrices.

    Elements that lie in one set only cannot be shared and are left out; the others go in slices
    of 8,192, so memory depends on the number of sets alone.
    """
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    place = np.where(often, np.cumsum(often) - 1, -1)[place]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for at in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(place, [at, at + COLUMNS])
        present = np.zeros((len(sets), int(place[b - 1]) - at + 1), dtype=np.float32)
        present[owner[a:b], place[a:b] - at] = 1
        out += present @ present.T
    return out


def _verified(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Of each task (cluster, lo, hi) the members with their links and the first member they reach."""
    for (cluster, lo, hi), rows in in_groups(batches, ["cluster", "lo", "hi"]):
        rows = rows.drop_duplicates("node").sort_values("node")
        if len(rows) < 2:
            continue
        sets = [np.frombuffer(g, dtype=np.uint64) for g in rows["grams"]]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        shared = shared_counts(sets).astype(np.float64)
        linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if lo != hi:
            side = rows["block"].to_numpy() == lo
            linked &= side[:, None] != side[None, :]
        if not linked.any():
            continue
        # a pair of several clusters counts in the smallest of them
        smaller = [[c for c in many if c < cluster] for many in rows["clusters"]]
        known = {c: i for i, c in enumerate(sorted({c for many in smaller for c in many}))}
        own = linked
        if known:
            within = np.zeros((len(rows), len(known)), dtype=np.float32)
            for i, many in enumerate(smaller):
                within[i, [known[c] for c in many]] = 1
            own = linked & (within @ within.T == 0)
        node = rows["node"].to_numpy()
        links = own @ rows["copies"].to_numpy(dtype=np.float64)
        found = linked.any(axis=1)
        yield pd.DataFrame({"node": node, "links": links.astype(np.int64), "root": node[local_roots(linked)]})[found]


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, width: int = 5) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_links.

    Documents link if the Jaccard similarity of their sets of word `width`-grams is at least
    `threshold`. `n_links` counts the other documents a document links with, `copy_of` is the
    smallest id with the same set, `class_id` the smallest id reachable by links.

    A word is a run of letters and digits in lower case. A text of fewer words has one n-gram of
    all of them; a NULL text or one without words has none and links with nothing, nor does a row
    with a NULL id. Repeated rows are copies of each other. An empty table gives no rows.

    Plan: equal sets become one node first, so copies cost one count. Nodes with a band hash in
    common form a cluster named by the smallest of them; bands that agree name the same cluster,
    so near copies meet once and not once per band. A cluster is compared in blocks of 1,024
    nodes, one task per pair of blocks: no pair is ever a row, and a pair of several clusters
    counts in the smallest. Sets are built again from the texts of clustered nodes, so they are
    shuffled for those only.
    """
    bands, rows = banding(threshold)
    docs = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    with small_batches(docs.sparkSession, ROWS):
        prints = through_table(_fingerprints(docs, width, bands, rows), "prints")
    usable = prints.where("key is not null and doc_id is not null")
    first = F.min(F.struct("doc_id", "bands")).alias("first")
    nodes = usable.groupBy("key").agg(first, F.count("*").alias("copies"))
    nodes = through_table(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "first.doc_id", "first.bands", "copies"), "nodes")

    keys = nodes.select("node", F.explode("bands").alias("band"))
    leads = keys.groupBy("band").agg(F.min("node").alias("cluster"), F.count("*").alias("n")).where("n > 1").select("band", "cluster")
    members = through_table(keys.join(leads, "band").select("cluster", "node").distinct(), "members")
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    tasks = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    task = lambda k: F.struct(
        "cluster", F.least("block", k).alias("lo"), F.greatest("block", k).alias("hi"), F.col("block").alias("block")
    )
    tasks = tasks.withColumn("tasks", F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), task))
    plans = tasks.groupBy("node").agg(F.flatten(F.collect_list("tasks")).alias("tasks"), F.collect_list("cluster").alias("clusters"))
    wanted = plans.join(nodes.select("node", "key", "doc_id", "copies"), "node")
    sets = _with_sets(docs.join(wanted, "doc_id").select("text", "key", "node", "copies", "clusters", "tasks"), width)
    work = sets.select("node", "copies", "clusters", "grams", F.explode("tasks").alias("t")).select("node", "copies", "clusters", "grams", "t.*")
    work = work.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
    with small_batches(docs.sparkSession, ROWS):
        found = through_table(work.mapInPandas(lambda it: _verified(it, threshold), "node long, links long, root long"), "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "key", "doc_id", "copies").join(links, "node", "left").join(reached, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    named = through_table(named, "named")
    names = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = named.join(names, "component").select(
        "key", F.col("doc_id").alias("copy_of"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    ids = prints.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    out = ids.join(named, "key", "left")
    none = lambda c: F.coalesce(c, F.col("doc_id"))
    return out.select(
        "doc_id", none(F.col("class_id")).alias("class_id"), none(F.col("copy_of")).alias("copy_of"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """`docs` without the documents that another one of smaller id stands for; all columns kept.

    Rows with a NULL id stay, and so do all rows with the id that stands for its class.
    """
    classes = jaccard_join(docs, doc_id=doc_id, **options)
    gone = classes.where("class_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")


def recall_of(similarity: float, bands: int, rows: int) -> float:
    """Share of pairs of that similarity that at least one band brings together."""
    return 1 - (1 - similarity**rows) ** bands


"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of 32 dimensions or more. The squared distance
that a link may have is shared out among the blocks in proportion to their variance; a pair that
exceeded its budget in every block would exceed the sum. So each block is range-joined under its
own budget, and every candidate of any block is checked on the whole vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import components, in_groups, pick, through_table

#: Dimensions of a block. In few dimensions many vectors lie within a budget by chance, and each block
#: compares most pairs again; in 32 hardly any that do not link do.
BLOCK_DIMS = 32
#: Vectors that the rotation is fitted on; it decides how fast the join is, not what it finds.
SAMPLE = 5_000
#: Vectors of a cell that one task compares, and rows of the matrix it holds at a time.
PIECE, TILE = 16_384, 512
SLACK, EXACT = 1e-4, 1e-9


@dataclass(frozen=True)
class Blocks:
    """Rotation, the columns of each block (its widest first), and the budgets."""

    rotation: np.ndarray
    columns: list[np.ndarray]
    budgets: np.ndarray

    @staticmethod
    def of(units: np.ndarray, threshold: float) -> Blocks:
        dims = units.shape[1]
        count = max(1, dims // BLOCK_DIMS)
        centred = units - units.mean(axis=0) if len(units) else np.zeros((1, dims))
        variance, vectors = np.linalg.eigh(centred.T @ centred / max(1, len(units)) + 1e-9 * np.eye(dims))
        order = np.argsort(-variance, kind="stable")
        columns = [np.arange(b, dims, count) for b in range(count)]
        share = np.array([variance[order][c].sum() for c in columns])
        return Blocks(vectors[:, order], columns, (2 - 2 * threshold) * share / share.sum())

    @property
    def widths(self) -> np.ndarray:
        """Cell widths of the leading coordinates: partners lie in the same cell or the next."""
        return np.sqrt(self.budgets) * (1 + 1e-6) + 1e-6

    def cells(self, units: np.ndarray) -> np.ndarray:
        leading = np.stack([(units @ self.rotation)[:, c[0]] for c in self.columns], axis=1)
        return np.floor(leading / self.widths).astype(np.int64)


def unit_vectors(raw: list) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _models(vectors: DataFrame, threshold: float) -> dict[int, Blocks]:
    sample = vectors.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("raw").toPandas()  # the documented bound
    by_dims: dict[int, list] = {}
    for raw in sample["raw"]:
        by_dims.setdefault(len(raw) // 8, []).append(raw)
    return {dims: Blocks.of(unit_vectors(raws), threshold) for dims, raws in by_dims.items()}


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as bytes with a key of their components; none for what links with nothing."""
    for batch in batches:
        keys, raws = [], []
        for vector in batch["embedding"]:
            usable = vector is not None and len(vector) > 0 and not any(v is None for v in vector)
            x = np.asarray(vector, dtype=np.float64) if usable else np.zeros(0)
            norm = np.linalg.norm(x) if len(x) and np.isfinite(x).all() else 0.0
            if norm > 0 and np.isfinite(norm):
                raws.append((x + 0.0).tobytes())
                keys.append(hashlib.blake2b(raws[-1], digest_size=16).digest())
            else:
                raws.append(None)
                keys.append(None)
        yield pd.DataFrame({"vec_id": batch["vec_id"].to_numpy(), "key": keys, "raw": raws})


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[i] and b[i] for all i; roots are the smallest members."""
    while True:
        for x in (a, b):
            while (parent[parent[x]] != parent[x]).any():
                parent[x] = parent[parent[x]]
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def _compared(batches: Iterator[pd.DataFrame], models: dict[int, Blocks], threshold: float) -> Iterator[pd.DataFrame]:
    """Of each task the nodes that link, the copies they link with, and the first node they reach."""
    for (dims, block, _, kind, lo, hi), rows in in_groups(batches, TASK):
        rows = rows.drop_duplicates("node").sort_values("node")
        if len(rows) < 2:
            continue
        model = models.get(int(dims)) or Blocks.of(np.zeros((0, int(dims))), threshold)
        units = unit_vectors(rows["raw"].tolist())
        turned = units @ model.rotation
        part = turned[:, model.columns[block]]
        square, one = (part * part).sum(axis=1, keepdims=True), np.ones((len(part), 1))
        # one matrix product gives the budget less the squared distance, 2 xy - |x|^2 - |y|^2 + budget
        rest = model.budgets[block] + SLACK - square
        here, there = (np.hstack(x).astype(np.float32) for x in ([2 * part, rest, -one], [part, one, square]))
        side = rows["side"].to_numpy().astype(bool)
        within = kind == 0 and lo == hi
        left, right = (np.arange(len(rows)),) * 2 if within else (np.flatnonzero(side), np.flatnonzero(~side))
        copies = rows["copies"].to_numpy(dtype=np.float64)
        links, parent = np.zeros(len(rows)), np.arange(len(rows))
        budgets = model.budgets
        for at in range(0, len(left), TILE):
            i, against = left[at : at + TILE], right[at:] if within else right
            p, q = np.divmod(np.flatnonzero(here[i] @ there[against].T >= 0), max(1, len(against)))
            p, q = i[p], against[q]
            if within:
                p, q = p[p < q], q[p < q]
            for start in range(0, len(p), 1 << 18):
                a, b = p[start : start + (1 << 18)], q[start : start + (1 << 18)]
                close = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                a, b = a[close], b[close]
                if not len(a):
                    continue
                # a pair that several blocks find counts in the first
                gaps = (turned[a] - turned[b]) ** 2
                inside = np.stack([gaps[:, c].sum(axis=1) <= budgets[k] + EXACT for k, c in enumerate(model.columns)], axis=1)
                first = inside.argmax(axis=1) == block
                a, b = a[first], b[first]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                merge(parent, a, b)
        every = np.arange(len(rows))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        found = (links > 0) | (parent != every)
        if found.any():
            node = rows["node"].to_numpy()
            yield pd.DataFrame({"node": node, "links": links.astype(np.int64), "root": node[parent]})[found]


TASK = ["dims", "block", "cell", "kind", "lo", "hi"]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of the same length link if their cosine, in double precision, is at least `threshold`.
    `n_links` counts the other vectors linked directly, `component_id` is the smallest id
    reachable, `kept` whether that is the vector's own. A vector that is NULL, empty, zero or has
    a NULL or non-finite component links with nothing, nor does a row with a NULL id. Repeated
    rows are copies, which link. An empty table gives no rows.

    Equal vectors become one node. For each block the nodes are cut into cells along the block's
    widest coordinate, as wide as the block's budget reaches, and meet their own and the next
    cell. A large cell is compared in pieces of 16,384 nodes, one task per pair of pieces. Pairs
    are counted where they are found and never become rows. Vectors spread alike over many
    dimensions share most cells, so each block compares up to all pairs once, by matrix products in
    bounded tiles: exact, and still quadratic.
    """
    rows = pick(vectors, vec_id=vec_id, embedding=embedding).withColumn("vec_id", F.col("vec_id").cast("long"))
    read = through_table(rows.mapInPandas(_read, "vec_id long, key binary, raw binary"), "vectors")
    usable = read.where("key is not null and vec_id is not null")
    nodes = usable.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("raw").alias("raw"))
    nodes = through_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    models = _models(nodes, threshold)
    shared = rows.sparkSession.sparkContext.broadcast(models)  # a square matrix per length in the sample

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["raw"].map(len) // 8
            for d in sorted(set(dims)):
                part = batch[dims == d]
                model = shared.value.get(d) or Blocks.of(np.zeros((0, d)), threshold)
                cells = model.cells(unit_vectors(part["raw"].tolist()))
                yield part[["node", "copies", "raw"]].assign(dims=d, cells=list(cells))

    placed = through_table(nodes.select("node", "copies", "raw").mapInPandas(place, "node long, copies long, raw binary, dims long, cells array<long>"), "cells")
    each = placed.select("node", "dims", F.posexplode("cells").alias("block", "cell"))
    counts = each.groupBy("dims", "block", "cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    counts = through_table(counts, "pieces")
    shifted = lambda by, name: counts.select("dims", "block", (F.col("cell") + by).alias("cell"), F.col("pieces").alias(name))
    keys = ["dims", "block", "cell"]
    each = each.join(shifted(0, "own"), keys).join(shifted(1, "before"), keys, "left").join(shifted(-1, "after"), keys, "left")
    each = each.withColumn("piece", F.pmod(F.xxhash64("node"), "own").cast("int"))
    upto = lambda name: F.when(F.coalesce(name, F.lit(0)) > 0, F.sequence(F.lit(0), F.col(name) - 1)).otherwise(F.array().cast("array<int>"))

    def entry(cell, kind: int, lo, hi, side):
        return F.struct(
            cell.cast("long").alias("cell"), F.lit(kind).alias("kind"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), side.alias("side")
        )

    piece, cell = F.col("piece"), F.col("cell")
    tasks = F.concat(
        F.transform(upto("own"), lambda k: entry(cell, 0, F.least(piece, k), F.greatest(piece, k), piece <= k)),
        F.transform(upto("before"), lambda k: entry(cell, 1, piece, k, F.lit(True))),
        F.transform(upto("after"), lambda k: entry(cell + 1, 1, k, piece, F.lit(False))),
    )
    work = each.select("node", "block", F.explode(tasks).alias("t")).select("node", "block", "t.*")
    work = work.join(placed.select("node", "copies", "raw", "dims"), "node")
    work = work.repartition(*TASK).sortWithinPartitions(*TASK)
    found = work.mapInPandas(lambda it: _compared(it, shared.value, threshold), "node long, links long, root long")
    found = through_table(found, "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "key", "vec_id", "copies").join(links, "node", "left").join(reached, "node", "left")
    named = through_table(named.withColumn("component", F.coalesce("component", "node")), "named")
    names = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = named.join(names, "component").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    ids = read.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key"))
    out = ids.join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees, one feature (or one pair) at a time, leaves a lookup table per
feature and pair. A score is the sum of the table entries of a text's bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import pick

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 24, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAST_LEAF = 150, 60, 0.15, 8

FEATURES = (
    "chars", "words", "word_length", "long_words", "upper", "digits", "symbols", "spaces", "lines", "line_length",
    "word_variety", "line_repeats", "word_repeats", "char_entropy", "longest_run", "symbol_words", "sentence_ends", "common_word",
)


def _kinds() -> np.ndarray:
    """Class of each byte: 0 other letters (non-ASCII), 1 lower, 2 upper, 3 digit, 4 space, 5 symbol."""
    kinds = np.full(256, 5, dtype=np.uint8)
    kinds[128:] = 0
    kinds[97:123], kinds[65:91], kinds[48:58] = 1, 2, 3
    kinds[[9, 10, 11, 12, 13, 32]] = 4
    return kinds


KINDS = _kinds()


def features(text: str | None) -> list[float]:
    """The measures of FEATURES for one text; NULL counts as empty, and all of it is read."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(data)
    if not n:
        return [0.0] * len(FEATURES)
    letters = np.bincount(data, minlength=256)
    kinds = np.bincount(KINDS, weights=letters, minlength=6)
    tokens = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    words = len(tokens)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=words)
    counts: dict[str, int] = {}
    for token in tokens:
        counts[token] = counts.get(token, 0) + 1
    share = letters[letters > 0] / n
    run = 1
    if n > 1:
        edges = np.flatnonzero(data[1:] != data[:-1])
        run = int(np.diff(np.concatenate([[-1], edges, [n - 1]])).max())
    followed = len(set(zip(tokens, tokens[1:], strict=False)))
    ends = sum(1 for t in tokens if t[-1] in ".!?")
    odd = sum(1 for t in tokens if not t[-1].isalnum() and t[-1] not in ".,;:!?\"')")
    return [
        math.log1p(n),
        math.log1p(words),
        float(lengths.mean()) if words else 0.0,
        float((lengths > 15).mean()) if words else 0.0,
        float(kinds[2] / n),
        float(kinds[3] / n),
        float(kinds[5] / n),
        float(kinds[4] / n),
        math.log1p(len(lines)),
        n / max(1, len(lines)),
        len(counts) / max(1.0, words) ** 0.75,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - followed / max(1, words - 1) if words > 1 else 0.0,
        float(-(share * np.log2(share)).sum()),
        math.log1p(run),
        odd / max(1, words),
        ends / max(1, words),
        max(counts.values(), default=0) / max(1, words),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the column `features`, an array of the measures of the text."""

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts])

    return docs.withColumn("features", measure(F.col(f"`{text}`")))


@dataclass(frozen=True)
class Model:
    """Cut points and tables; a text's log odds are the base and one entry of each table."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[tuple[np.ndarray, np.ndarray]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.base)
        for i, (cut, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            odds += table[np.searchsorted(cut, x[:, i], side="right")]
        for (i, j), (ci, cj), table in zip(self.pairs, self.pair_cuts, self.pair_tables, strict=True):
            odds += table[np.searchsorted(ci, x[:, i], side="right"), np.searchsorted(cj, x[:, j], side="right")]
        return 1 / (1 + np.exp(-odds))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step of a shallow tree over ordered bins, from sums of gradient, curvature and rows."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    gain[(nl < LEAST_LEAF) | (n.sum() - nl < LEAST_LEAF)] = 0
    at = int(gain.argmax())
    if gain[at] <= 1e-9:
        return out
    return np.concatenate([_tree(g[: at + 1], h[: at + 1], n[: at + 1], depth - 1), _tree(g[at + 1 :], h[at + 1 :], n[at + 1 :], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut in both directions of a grid of sums: its gain and the step of its quadrants."""
    total, best, step = _gain(g.sum(), h.sum()), 0.0, np.zeros(g.shape)
    cg, ch, cn = (x.cumsum(0).cumsum(1) for x in (g, h, n))
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            parts = []
            for c in (cg, ch, cn):
                a, b, d = c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j]
                parts.append(np.array([[a, b], [d, c[-1, -1] - a - b - d]]))
            gain = (_gain(parts[0], parts[1]) * (parts[2] >= LEAST_LEAF)).sum() - total
            if gain > best:
                best = gain
                move = parts[0] / (parts[1] + 1.0) * (parts[2] >= LEAST_LEAF)
                step = np.repeat(np.repeat(move, [i + 1, g.shape[0] - i - 1], axis=0), [j + 1, g.shape[1] - j - 1], axis=1)
    return best, step


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost main effects in turn, then the pairs whose grid explains most of what is left."""
    rate = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    base = math.log(rate / (1 - rate))
    cuts = [_cuts(x[:, i], BINS) if len(x) else np.zeros(0) for i in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    odds = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS if len(y) else 0):
        for i, b in enumerate(binned):
            g, h = slopes()
            size = len(tables[i])
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), np.bincount(b, minlength=size))
            tables[i] += step
            odds += step[b]
    pair_cuts = [_cuts(x[:, i], PAIR_BINS) if len(x) else np.zeros(0) for i in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(pair_cuts)]

    def grid(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        return coarse[i] * (len(pair_cuts[j]) + 1) + coarse[j], (len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)

    def sums(i: int, j: int) -> tuple[np.ndarray, ...]:
        cell, shape = grid(i, j)
        g, h = slopes()
        size = shape[0] * shape[1]
        return tuple(np.bincount(cell, w, size).reshape(shape) for w in (g, h, np.ones(len(g))))

    found = sorted(((-_quadrants(*sums(i, j))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)) if len(y) else [])
    pairs = [(i, j) for _, i, j in found[:PAIRS]]
    pair_tables = [np.zeros(grid(i, j)[1]) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (i, j) in zip(pair_tables, pairs, strict=True):
            step = RATE * _quadrants(*sums(i, j))[1]
            table += step
            odds += step.ravel()[grid(i, j)[0]]
    return Model(base, cuts, tables, pairs, [(pair_cuts[i], pair_cuts[j]) for i, j in pairs], pair_tables)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label") -> Model:
    """Fit on at most 20,000 of the rows of `labels` (doc_id, label), by smallest hash of their id.

    Rows with a NULL label or id, or without a document, teach nothing; of equal ids the larger
    label counts. Only ids are sorted and broadcast (20,000 at most); texts stay where they are.
    """
    known = pick(labels, doc_id=doc_id, label=label).where("label is not null and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    known = known.orderBy("h", "doc_id").limit(TRAIN_ROWS)  # the documented bound
    rows = pick(docs, doc_id=doc_id, text=text).join(F.broadcast(known), "doc_id")
    sample = measured(rows).select("h", "features", "label").toPandas()
    sample = sample.assign(f=sample["features"].map(tuple)).sort_values(["h", "label", "f"])
    x = np.array(sample["f"].tolist(), dtype=np.float64).reshape(len(sample), len(FEATURES))
    return fit(x, sample["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1; replaces a column of that name), from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))
            yield pd.Series(shared.value.score(x))

    return docs.withColumn("score", judge(F.col(f"`{text}`")))

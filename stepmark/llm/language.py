"""Language identification with string kernels: Nystroem landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import pick, through_table

#: Documents per language that the classifier is fitted on, and how many of them are landmarks.
TRAIN_PER_CLASS, LANDMARKS_PER_CLASS = 300, 40
RIDGE = 1e-2
#: Texts, and cells of the presence matrix, that are scored at once.
BATCH, CELLS = 128, 1 << 23
CHUNK = 1 << 20
UNDETERMINED = "und"


def grams(text: str) -> np.ndarray:
    """The distinct 1-, 2- and 3-grams of the whole text in lower case, as sorted numbers.

    Every character has its own 21 bits, so no two n-grams share a number. Long texts go in
    overlapping pieces.
    """
    text, found = text.lower(), np.zeros(0, dtype=np.int64)
    for at in range(0, len(text), CHUNK):
        piece = text[at : at + CHUNK + 2].encode("utf-32-le", "surrogatepass")
        one = np.frombuffer(piece, dtype=np.uint32).astype(np.int64) + 1
        two = one[:-1] << 21 | one[1:]
        three = two[:-1] << 21 | one[2:]
        found = np.unique(np.concatenate([found, one, two, three]))
    return found


@dataclass(frozen=True)
class Classifier:
    """Blended-spectrum presence kernel, G(x) being the 1-, 2- and 3-grams of a text:
    k(x, z) = |G(x) and G(z)| / sqrt(|G(x)| |G(z)|).
    """

    features: np.ndarray  # sorted n-grams of the landmarks
    landmarks: np.ndarray  # features x landmarks: presence / sqrt(size of the landmark)
    weights: np.ndarray  # landmarks + 1 x classes
    classes: list[str]

    def similarities(self, texts: list[str]) -> np.ndarray:
        """Kernel values of texts against the landmarks: one matrix product a batch."""
        out = np.zeros((len(texts), self.landmarks.shape[1]))
        step = max(1, min(BATCH, CELLS // max(1, len(self.features))))
        for first in range(0, len(texts), step):
            batch = texts[first : first + step]
            present = np.zeros((len(batch), len(self.features)), dtype=np.float32)
            sizes = np.ones(len(batch))
            for i, text in enumerate(batch):
                found = grams(text)
                present[i, _among(found, self.features)] = 1
                sizes[i] = max(1, len(found))
            out[first : first + step] = present @ self.landmarks / np.sqrt(sizes)[:, None]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """One-versus-rest outputs, about 1 for the class of a text and -1 for the others."""
        return self.similarities(texts) @ self.weights[:-1] + self.weights[-1]


def _among(found: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places in `features` of those numbers of `found` that are there; both are sorted."""
    at = np.searchsorted(features, found)
    return at[(at < len(features)) & (features.take(at, mode="clip") == found)] if len(features) else at[:0]


def landmark_model(marks: list[np.ndarray], classes: list[str]) -> Classifier:
    """An unfitted classifier on the n-grams of its landmarks."""
    features = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *marks]))
    landmarks = np.zeros((len(features), len(marks)), dtype=np.float32)
    for i, found in enumerate(marks):
        landmarks[_among(found, features), i] = 1 / np.sqrt(max(1, len(found)))
    return Classifier(features, landmarks, np.zeros((len(marks) + 1, len(classes))), classes)


def fit_weights(model: Classifier, known: np.ndarray, labels: list[str], marks: list[int]) -> Classifier:
    """Nystroem ridge regression on kernel values; `marks` are the rows of the landmarks."""
    between = known[marks].astype(np.float64)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    good = values > 1e-6 * max(values.max(initial=0), 1e-12)
    map_ = vectors[:, good] / np.sqrt(values[good])  # kernel values -> Nystroem features
    known = known.astype(np.float64) @ map_
    mean = known.mean(axis=0)
    centred = known - mean
    truth = np.where(np.array(labels)[:, None] == np.array(model.classes)[None, :], 1.0, -1.0)
    share = truth.mean(axis=0)
    solved = np.linalg.solve(centred.T @ centred + RIDGE * len(labels) / 100 * np.eye(centred.shape[1]), centred.T @ (truth - share))
    weights = np.vstack([map_ @ solved, share - mean @ solved])
    return Classifier(model.features, model.landmarks, weights.astype(np.float32), model.classes)


def first_of_each(labels: list[str]) -> list[int]:
    """Rows of the landmarks: the first of each label, in the given order."""
    taken: dict[str, int] = {}
    marks = []
    for i, label in enumerate(labels):
        taken[label] = taken.get(label, 0) + 1
        if taken[label] <= LANDMARKS_PER_CLASS:
            marks.append(i)
    return marks


def fit(texts: list[str], labels: list[str]) -> Classifier:
    """The classifier of labelled texts, in the given order (the first are landmarks)."""
    marks = first_of_each(labels)
    model = landmark_model([grams(texts[i]) for i in marks], sorted(set(labels)))
    return fit_weights(model, model.similarities(texts), labels, marks)


def train(docs: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Classifier | None:
    """Fit on at most 300 documents of each language among the rows where `usable` holds.

    The sample is the rows of smallest hash of their id, so it does not depend on how the table
    is split. Its texts are used whole and stay on the executors: the driver gets the distinct
    n-grams of the landmarks, then one kernel value per row and landmark. The languages of a
    table are few: all this is bounded by their number.
    """
    rows = docs.where(usable)
    rows = pick(rows, doc_id=doc_id, text=text, lang=lang).where("lang is not null and text rlike '\\\\p{L}'")
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    chosen = rows.groupBy("lang", F.pmod("h", F.lit(TRAIN_PER_CLASS)).alias("part")).agg(F.min("h").alias("h"))
    chosen = F.broadcast(chosen.select("lang", "h"))  # at most 300 rows a language
    sample = through_table(rows.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("t")), "labelled")
    keys = sample.select("lang", "h").orderBy("lang", "h").toPandas()
    if not len(keys):
        return None
    labels = keys["lang"].tolist()
    marks = first_of_each(labels)
    spark = docs.sparkSession
    landmarks = F.broadcast(spark.createDataFrame(keys.iloc[marks], "lang string, h bigint"))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "grams": [grams(t) for t in batch["t"]]})

    taken = sample.join(landmarks, ["lang", "h"]).select("lang", "h", "t").mapInPandas(found, "lang string, h bigint, grams array<bigint>").toPandas()
    model = landmark_model([np.asarray(g) for g in taken.sort_values(["lang", "h"])["grams"]], sorted(set(labels)))
    shared = spark.sparkContext.broadcast(model)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "known": list(shared.value.similarities(batch["t"].tolist()))})

    known = sample.select("lang", "h", "t").mapInPandas(compare, "lang string, h bigint, known array<double>").toPandas()
    known = keys.merge(known, on=["lang", "h"], how="left")  # in the order of the keys
    return fit_weights(model, np.stack(known["known"].tolist()), labels, marks)


def predict(docs: DataFrame, model: Classifier | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, which replace columns of that name; see `with_guess`."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return with_guess(docs, model, text).select(*kept, F.col("__guess.lang_pred").alias("lang_pred"), F.col("__guess.score").alias("score"))


def with_guess(docs: DataFrame, model: Classifier | None, text: str = "text") -> DataFrame:
    """`docs` with `__guess`, struct(lang_pred, score); all columns kept, only the text is used.

    The score is the softmax of the one-versus-rest outputs (scale 4), 0 for `und`: text that
    is NULL or has no letter, or any text if there was nothing to learn from.

    The function is marked as nondeterministic, though it is not: else Spark moves a filter on
    `__guess` below the projection and scores each text twice, in two Python workers a task. So
    filters on other columns stay above it too: put them on `docs`.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the n-grams of the landmarks

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            labels = np.full(len(texts), UNDETERMINED, dtype=object)
            sure = np.zeros(len(texts))
            values = texts.tolist()
            known = [i for i, t in enumerate(values) if m is not None and t is not None and any(map(str.isalpha, t))]
            for at in range(0, len(known), BATCH):
                rows = known[at : at + BATCH]
                scores = m.scores([values[i] for i in rows]).astype(np.float64)
                raised = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
                best = scores.argmax(axis=1)
                labels[rows] = np.array(m.classes, dtype=object)[best]
                sure[rows] = (raised / raised.sum(axis=1, keepdims=True))[np.arange(len(rows)), best]
            yield pd.DataFrame({"lang_pred": labels, "score": sure})

    return docs.withColumn("__guess", guess.asNondeterministic()(F.col(f"`{text}`")))

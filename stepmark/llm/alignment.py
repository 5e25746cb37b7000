"""Alignment of two tokenizers: where both cut a text, which tokens end there, and how often.

A byte-level BPE (A) reads the text with a space before it, a sentencepiece BPE (B) the text, to
which it adds that space itself. Both give spans: character offsets and the spans of the piece
proto. A span is a coarse cut: where it has as many bytes as the token stands for, it says where
the token ends. Tokens that are parts of one character (byte-level pieces of a multibyte character,
byte-fallback pieces) share its span; their ends are the last sure cut and the bytes decoded since.

Neither tokenizer joins across a space that follows a character other than white space, nor a Latin
letter or digit with a mark after it: A's pattern ends a token there, and no piece of B's vocabulary
holds both (checked). So a text is the sum of its pieces cut there, every such place is a cut of
both, and each distinct piece is encoded and aligned once while a worker remembers it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import pick, small_batches, through_table
from stepmark.llm.pieces import Aligner, aligner

#: Texts that are aligned together, and rows of a task's counts that are kept before they go on.
TEXTS, WAITING = 128, 1_000_000
#: Rows of a batch of texts, or of the links of texts: few, beside two tokenizers and the pieces a worker keeps.
ROWS = 256
ALIGNED = "doc_id long, n_a long, n_b long, groups_sha256 string, links binary"


def most_pairs(aligned: Aligner) -> int:
    """A bound on the different links any corpus can have.

    Two tokens that end together agree from the end: one's bytes are a suffix of the other's. So
    a token links only with the tokens that its own suffixes spell, or that have it as a suffix;
    their number is at most the length of the longer token times the ids that share its bytes.
    """
    same_a, same_b = (max(Counter(x).values()) for x in (aligned.bytes_a, aligned.bytes_b))
    return int(aligned.sizes_a.sum() * same_b + aligned.sizes_b.sum() * same_a)


def align_texts(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, groups_sha256 and its links, written and read back.

    Each link is a * (size of B's vocabulary) + b, 32 bits, low byte first, one after the other. NULL
    and empty texts, and texts that a tokenizer changes (its tokens do not spell the text), have no
    tokens and an empty `groups_sha256`; ids may be NULL or repeat; an empty table gives no rows;
    other columns play no part.
    """
    if _vocabulary_product(path_a, path_b) > 2**31:
        raise ValueError("pairs of these vocabularies do not fit 32 bits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b).align
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows = list(align(part["text"].to_pylist()))
                sums = [hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "" for r in rows]
                links = pa.array([r.links.astype("<i4").tobytes() for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([r.n_a for r in rows], pa.int64()), pa.array([r.n_b for r in rows], pa.int64()), pa.array(sums, pa.string()), links],
                    ["doc_id", "n_a", "n_b", "groups_sha256", "links"],
                )
        aligner(path_a, path_b).clear()  # the worker lives on

    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with small_batches(docs.sparkSession, ROWS):
        return through_table(rows.mapInArrow(work, ALIGNED), "aligned")


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All links of a batch, and where those of each document begin and end."""
    lists = batch["links"].to_pylist()
    return np.frombuffer(b"".join(lists), "<i4"), np.cumsum([0, *(len(x) // 4 for x in lists)])


def _vocabulary_product(path_a: str, path_b: str) -> int:
    both = aligner(path_a, path_b)
    return len(both.bytes_a) * both.n_b


def link_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(link, n, best): how often each pair of ids is linked, and whether no pair of its B id is
    linked more often. Counted per task first; there are at most `most_pairs` rows at any size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, n = np.zeros(0, np.int32), np.zeros(0, np.int64)

        def put():
            return pa.RecordBatch.from_arrays([pa.array(links, pa.int32()), pa.array(n, pa.int64())], ["link", "n"])

        for batch in batches:
            new, times = np.unique(_links(batch)[0], return_counts=True)
            every, where = np.unique(np.concatenate([links, new]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n, times]), minlength=len(every)).astype(np.int64)
            links = every
            if len(links) > WAITING:
                yield put()
                links, n = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(links):
            yield put()

    counts = aligned.select("links").mapInArrow(count, "link int, n long").groupBy("link").agg(F.sum("n").alias("n"))
    counts = through_table(counts.withColumn("b", F.col("link") % n_b), "links")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Two passes: the texts are aligned and their links written; the links are counted over the corpus
    and looked up again. The counts go to every task: they are bounded by the two vocabularies, not
    by the corpus (`most_pairs`, checked here). For NULL, empty and repeated rows see `align_texts`.
    """
    aligned = align_texts(docs, path_a, path_b, doc_id, text)
    both = aligner(path_a, path_b)
    with small_batches(docs.sparkSession, ROWS):
        counts = link_counts(aligned, both.n_b).toArrow().sort_by("link")
    if counts.num_rows > most_pairs(both):
        raise RuntimeError("more links than the vocabularies allow")
    known, n, best = (counts[c].to_numpy() for c in ("link", "n", "best"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links, offsets = _links(batch)
            at = np.searchsorted(known, links)
            n_links = pa.array(np.diff(offsets), pa.int64())
            sums = [np.diff(np.append(0, np.cumsum(x[at], dtype=np.int64))[offsets]) for x in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_a"], batch["n_b"], n_links, n_links, *(pa.array(s, pa.int64()) for s in sums), batch["groups_sha256"]],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    with small_batches(docs.sparkSession, ROWS):
        return through_table(aligned.mapInArrow(look_up, schema), "counted")


def default_tokenizers() -> tuple[str, str]:
    """Paths of the public 50k byte-level and 32k piece vocabularies, where their package is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

"""Token-ID output: Arrow files of equal-length sequences with masks, written and read in tasks.

A file `part-NNNNN.arrow` holds record batches of fixed-size lists: `ids` (L token ids, 16 bits
where the vocabulary allows) and `mask` (L bits). Documents follow each other without gaps; the
end of the last sequence is padding, with its mask off. `part-NNNNN.docs.arrow` says where each
document lies. Both are memory-mapped or read by range: sequence s is row s % 256 of batch
s // 256, so any part is read without decoding the rest.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stepmark.llm.common import pick, shared_path, small_batches, through_table

LENGTH, BATCH = 2048, 256
#: Words that a worker keeps with their ids, and ids of them; beyond either it keeps those of the last texts.
MOST_KNOWN, MOST_CACHED = 400_000, 4_000_000
#: Latin letters that are one token run in any case and stay letters once they are normalized, with a
#: full stop or comma at the end or none. (The capital I with a dot becomes a letter and a sign.)
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
WORD = f"^[{LETTERS}]+[.,]?$"
#: What the tokenizer takes apart first, in pieces of these letters and ASCII without an apostrophe.
RUNS = re.compile(f"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
PLAIN = re.compile(f"[{LETTERS}!-&(-~]+")
#: Texts that are encoded together.
TEXTS = 1024
MANIFEST = "part int, path string, n_tokens long, n_docs long"


def _byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in a byte-level vocabulary: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts, equal to the tokenizer's, each distinct word encoded once.

    This tokenizer drops white space and never joins across it, so a text is the sum of the
    pieces between spaces. A piece of Latin letters, in lower case and without a full stop or comma
    at its end, is a word that goes to the merges directly; the mark is a token by itself. A piece of
    such letters and other ASCII is taken apart into runs; any other takes the tokenizer's whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.marks = [(m, self.merge(m)[0].id) for m in ".,"]
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.large_string())  # in an Arrow array a word takes its bytes, not an object
        self.flat = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)  # the ids of word i are flat[ends[i] : ends[i + 1]]

    def _word(self, word: str) -> list[int]:
        """The ids of one run in lower case: letters are spelled by their bytes."""
        return [t.id for t in self.merge(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))]

    def _piece(self, piece: str) -> list[int]:
        if "<|" not in piece and PLAIN.fullmatch(piece):  # names of special tokens stay as they are
            return [*chain.from_iterable(map(self._word, RUNS.findall(piece.lower())))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _places(self, words: pa.Array, plain: np.ndarray) -> np.ndarray:
        """The place of each of some distinct words; those not known yet are encoded."""
        found = pc.index_in(words, self.known)
        missing = found.is_null()
        found = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if missing.true_count:
            new = words.filter(missing)
            places = np.flatnonzero(missing.to_numpy(zero_copy_only=False))
            found[places] = np.arange(len(self.known), len(self.known) + len(new))
            ids, ends = [], []
            for word, letters in zip(new.to_pylist(), plain[places].tolist(), strict=True):
                ids += self._word(word) if letters else self._piece(word)
                ends.append(len(ids))
            self.ends = np.append(self.ends, np.array(ends, dtype=np.int64) + len(self.flat))
            self.flat = np.append(self.flat, np.array(ids, dtype=np.uint32))
            self.known = pa.concat_arrays([self.known, new])
        return found

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of distinct pieces the place of the word, and the id of the mark at the end (0: none)."""
        plain = pc.match_substring_regex(pieces, WORD)
        coded = pc.if_else(plain, pc.utf8_rtrim(pc.utf8_lower(pieces), ".,"), pieces).dictionary_encode()
        plain, word = plain.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        letters = np.zeros(len(coded.dictionary), dtype=bool)
        letters[word] = plain
        mark = np.zeros(len(pieces), dtype=np.uint32)
        for character, token in self.marks:
            mark[plain & pc.ends_with(pieces, character).to_numpy(zero_copy_only=False)] = token
        return self._places(coded.dictionary, letters)[word], mark

    def _forget(self, used: np.ndarray) -> None:
        """Keep the words at the places `used` only, as many as may be kept."""
        used = np.unique(used)
        n = self.ends[used + 1] - self.ends[used]
        few = min(MOST_KNOWN, int(np.searchsorted(np.cumsum(n), MOST_CACHED, side="right")))
        used, n = used[:few], n[:few]
        ends = np.append(0, np.cumsum(n))
        self.flat = self.flat[np.repeat(self.ends[used] - ends[:-1], n) + np.arange(ends[-1])]
        self.known, self.ends = self.known.take(pa.array(used)), ends

    def encode_all(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; the distinct pieces of all of them are looked up once."""
        if not len(texts):
            return
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        at, mark = self._pieces(coded.dictionary)
        piece, starts = coded.indices.to_numpy(), self.ends[at]
        n = (self.ends[at + 1] - starts + (mark > 0))[piece]
        before = np.append(0, np.cumsum(n))
        ids = self.flat.take(np.repeat(starts[piece] - before[:-1], n) + np.arange(before[-1]), mode="clip")
        mark = mark[piece]
        ids[before[1:][mark > 0] - 1] = mark[mark > 0]  # there the first id of the next word was taken
        if len(self.known) > MOST_KNOWN or len(self.flat) > MOST_CACHED:
            self._forget(at)
        cuts = before[np.asarray(lists.offsets)].tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield ids[a:b]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker: its words are kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Writer:
    """Appends ids to one file of equal-length sequences."""

    def __init__(self, sink, kind: pa.DataType, length: int, pad: int):
        self.kind, self.length, self.pad = kind, length, pad
        lists = {"ids": pa.list_(kind, length), "mask": pa.list_(pa.bool_(), length)}
        self.schema = pa.schema([pa.field(name, kind, False) for name, kind in lists.items()])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BATCH * self.length:
            self._put(False)

    def _put(self, last: bool) -> None:
        ids = np.concatenate([*self.parts, np.zeros(0, dtype=np.uint32)]).astype(self.kind.to_pandas_dtype())
        step, at = BATCH * self.length, 0
        while len(ids) - at >= step or (last and at < len(ids)):
            piece = ids[at : at + step]
            rows = -(-len(piece) // self.length)
            full = np.full(rows * self.length, self.pad, dtype=piece.dtype)
            full[: len(piece)] = piece
            mask = np.arange(len(full)) < len(piece)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, mask)]
            self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
            at += step
        self.parts, self.waiting = [ids[at:].astype(np.uint32)], max(0, len(ids) - at)

    def close(self) -> None:
        self._put(True)
        self.writer.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, length: int = LENGTH) -> DataFrame:
    """Encode every text, append `end_id`, write the files in ascending id order; returns the manifest.

    Documents are dealt out by ranges of their id and sorted inside; each range is a file pair. A
    task writes under a name of its own attempt and renames at the end, so a task that runs again
    replaces whole files. Only one batch of 256 sequences of a file is in memory, and a batch of
    `TEXTS` texts. NULL and empty
    texts have the end id only; NULL ids come first; rows with equal ids follow by their text.
    """
    from tokenizers import Tokenizer

    kind = pa.uint16() if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else pa.uint32()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encode_all = encoder(tokenizer).encode_all
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = f"{root}/part-{part:05d}"
        ids, counts, writer, sink = [], [], None, None
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                for key, found in zip(some["doc_id"].to_pylist(), encode_all(pc.fill_null(some["text"], "")), strict=True):
                    if writer is None:
                        sink = fs.open_output_stream(f"{name}.{attempt}.part")
                        writer = _Writer(sink, kind, length, end_id)
                    coded = np.append(found, np.uint32(end_id)).astype(np.uint32)
                    writer.add(coded)
                    ids.append(key)
                    counts.append(len(coded))
        if writer is None:
            return
        writer.close()
        sink.close()
        sizes = np.array(counts, dtype=np.int64)
        places = pa.table({"doc_id": pa.array(ids, pa.int64()), "first": np.cumsum(sizes) - sizes, "n_tokens": sizes})
        with fs.open_output_stream(f"{name}.docs.{attempt}.part") as out, pa.ipc.new_file(out, places.schema) as table:
            table.write_table(places, max_chunksize=1 << 16)
        fs.move(f"{name}.{attempt}.part", f"{name}.arrow")
        fs.move(f"{name}.docs.{attempt}.part", f"{name}.docs.arrow")
        of_part = [[part], [f"{folder}/part-{part:05d}"], [int(sizes.sum())], [len(sizes)]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([*map(pa.array, of_part, kinds)], ["part", "path", "n_tokens", "n_docs"])

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranges = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with small_batches(docs.sparkSession, TEXTS):
        return through_table(ranges.mapInArrow(write, MANIFEST), "manifest")


class TokenFile:
    """Random access to one file pair; on a local path pages are mapped, not read."""

    def __init__(self, path: str):
        fs, name = _filesystem(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        opened = [pa.memory_map(f"{name}{end}") if local else fs.open_input_file(f"{name}{end}") for end in (".arrow", ".docs.arrow")]
        self.tokens, self.docs = map(pa.ipc.open_file, opened)
        self.length = self.tokens.schema.field("ids").type.list_size
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def sequence(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence `s`."""
        batch = self.tokens.get_batch(s // BATCH)
        row = batch.slice(s % BATCH, 1)
        return row["ids"].flatten().to_numpy(), row["mask"].flatten().to_numpy(zero_copy_only=False)

    def ids(self, first: int, n: int) -> np.ndarray:
        """`n` ids from place `first` of the file on."""
        step, parts = BATCH * self.length, []
        while n > 0:
            at = first // step
            if self.held[0] != at:
                self.held = (at, self.tokens.get_batch(at)["ids"].flatten().to_numpy())
            piece = self.held[1][first - at * step : first - at * step + n]
            parts.append(piece)
            first, n = first + len(piece), n - len(piece)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32.

    `start` is the number of ids of all documents before it. A file is read in one task, batch by
    batch; only the sums of the manifest's token counts meet in one.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _ENCODERS.clear()  # all texts are written: their words are not needed any more in this worker
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"], strict=True):
                file = TokenFile(path)
                for b in range(file.docs.num_record_batches):
                    places = file.docs.get_batch(b)
                    first, n = places["first"].to_numpy(), places["n_tokens"].to_numpy()
                    sums = [zlib.crc32(file.ids(int(f), int(k)).astype("<u4").tobytes()) for f, k in zip(first, n, strict=True)]
                    ids = places["doc_id"].to_pandas(integer_object_nulls=True)
                    yield pd.DataFrame({"doc_id": ids, "start": first + before, "n_tokens": n, "ids_crc32": np.array(sums, dtype=np.int64)})

    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = through_table(manifest.withColumn("before", before.cast("long")), "files")  # one row a file
    files = files.repartition(files.sparkSession.sparkContext.defaultParallelism, "part")
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    """Path of the public 49k word vocabulary, where its package is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder."""
    return shared_path(spark, "tokens")

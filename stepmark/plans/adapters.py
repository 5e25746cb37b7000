"""Examples, images, listings and logs derived from the given tables.

The rules below are the same in the SQL of `plans.sql`. All but the run log are row-local: an
example is made from one document, so building it neither groups nor shuffles.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmark.functions.refs import rewrite_prefix
from stepmark.functions.text import BAD, GOOD, IMAGE, tokenize_text
from stepmark.operators.batches import seeded_hash
from stepmark.operators.messages import (
    clean_items_media_first,
    content_item,
    drop_empty_messages,
    render_chat,
)
from stepmark.operators.metrics import log_steps
from stepmark.operators.tokens import full_vocab, in_blocks, token_ids, vocab_lookup
from stepmark.schemas import MESSAGE
from stepmark.session import shared_path, spread, through_table
from stepmark.sources.files import open_storage

REMOTE = "s3://bucket/base/"
BASE = "/data/images"
VOCAB_SIZE = 3000  # of the query `build_vocab`, a top-n; all other queries take the whole vocabulary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _message(role: Column | str, *items: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), F.array(*items).alias("content")).cast(MESSAGE)


def _mark(*parts: Column) -> Column:
    return F.when(F.substring(seeded_hash(*parts), 1, 1) < "8", GOOD).otherwise(BAD)


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, images, messages): each line of a document is a step, followed by its mark."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    doc = F.col("doc_id")
    image = content_item(
        "image", image=F.when(doc % 5 != 0, IMAGE), index=(doc % 3)
    )

    def step(line: Column, k: Column) -> Column:
        text = content_item("text", text=F.when((doc + k) % 11 != 0, line))
        user = F.when(k == 0, _message("user", text, image)).otherwise(_message("user", text))
        return F.array(user, _message("assistant", content_item("text", text=_mark(doc, k))))

    steps = F.flatten(F.transform(F.split("text", "\n"), step))
    system = F.array(_message("system", content_item("text", text=F.col("source"))))
    return docs.select("doc_id", image_uris(doc).alias("images"), F.concat(system, steps).alias("messages"))


def image_uris(doc: Column) -> Column:
    """As many remote images as the id modulo four."""
    numbers = F.when(doc % 4 > 0, F.sequence(F.lit(0).cast("bigint"), doc % 4 - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.transform(
        numbers, lambda n: F.concat(F.lit(REMOTE), doc.cast("string"), F.lit("/"), n.cast("string"), F.lit(".png"))
    )


def image_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, images) of the examples, from the id column alone."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", image_uris(F.col("doc_id")).alias("images"))


def local_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, images, messages) with image references rewritten to the base folder."""
    return examples(spark, sf_dir).withColumn("images", rewrite_prefix(F.col("images"), REMOTE, BASE))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path) of the images that exist: one in ten does not."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    numbered = docs.select("doc_id", F.posexplode(rewrite_prefix(image_uris(F.col("doc_id")), REMOTE, BASE)))
    return numbered.where((F.col("doc_id") * 7 + F.col("pos")) % 10 != 0).select(F.col("col").alias("path"))


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): cleaned and rendered messages."""
    messages = drop_empty_messages(clean_items_media_first(F.col("messages")))
    return examples(spark, sf_dir).select("doc_id", render_chat(messages).alias("text"))


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(spark, sf_dir).select("doc_id", tokenize_text(F.col("text")).alias("tokens"))


def corpus_vocab(tokens: DataFrame) -> DataFrame:
    """All tokens of the rendered examples, written once and read from there."""
    return through_table(full_vocab(tokens), "vocab")


def pad_id_of(vocab: DataFrame) -> int:
    """The id after the last one of the vocabulary."""
    return vocab.agg(F.coalesce(F.max("token_id"), F.lit(-1)) + 1).first()[0]


def encoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, ids) and the vocabulary."""
    df, vocab = encoded_blocks(spark, sf_dir)
    return df.drop("block"), vocab


def encoded_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, block, ids), where another lookup may use the same blocks, and the vocabulary.

    The tokens are written once; the vocabulary and the lookup both read them.
    """
    tokens = in_blocks(tokenized(spark, sf_dir), "block")
    vocab = corpus_vocab(tokens)
    return vocab_lookup(tokens, vocab, "doc_id", block="block").select("doc_id", "block", "ids"), vocab


def mark_ids(vocab: DataFrame) -> tuple[int, int]:
    """Ids of the good and the bad mark."""
    ids = token_ids(vocab, [GOOD, BAD])
    return ids[GOOD], ids[BAD]


def turn_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, messages): every turn of a conversation as an example of one message.

    Assistant turns carry a mark instead of their text. Turns are not collected per
    conversation; counts per conversation are summed from them.
    """
    turns = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    text = F.when((conv + turn) % 11 == 0, F.lit(None)).otherwise(
        F.when(F.col("role") == "assistant", _mark(conv, turn)).otherwise(F.col("text"))
    )
    return turns.select("conv_id", "turn", F.array(_message(F.col("role"), content_item("text", text=text))).alias("messages"))


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image sides with optional bounds and optional requested sides."""
    items = table(spark, sf_dir, "lineitem")
    order, part, supp, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return items.select(
        order, line,
        (1 + (order * 37) % 4000).alias("height"),
        (1 + (part * 53) % 4000).alias("width"),
        F.when(line % 2 == 0, line * 3136).cast("bigint").alias("min_pixels"),
        F.when(line % 3 == 0, line * 78400).cast("bigint").alias("max_pixels"),
        F.when(supp % 2 == 0, 1 + (supp * 31) % 2000).alias("resized_height"),
        F.when(supp % 3 == 0, 1 + (supp * 17) % 2000).alias("resized_width"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, event_id, ts, loss): every event is a logged step of the run of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "event_id", "ts", F.col("value").alias("loss")
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its steps numbered."""
    return log_steps(raw_log(spark, sf_dir))


def _png(pixels: np.ndarray) -> bytes:
    """A PNG file of a (height, width, channels) byte array with 1, 3 or 4 channels."""

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    height, width, channels = pixels.shape
    color_type = {1: 0, 3: 2, 4: 6}[channels]
    lines = b"".join(b"\0" + row.tobytes() for row in pixels)
    header = struct.pack(">IIBBBBB", width, height, 8, color_type, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    )


def image_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """PNG files drawn from the embeddings, one per vector, and their folder and (vec_id, path).

    Channel c of pixel i is element (i + c) mod 64, scaled to a byte; gray, RGB and RGBA take
    turns. Tasks write the files; one that runs again writes the same bytes again.
    """
    folder = shared_path(spark, "png")
    storage, root = fs.FileSystem.from_uri(folder)
    vectors = spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage.create_dir(root)
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                levels = np.floor(np.array(row["embedding"], np.float64) * 1000).astype(np.int64) % 256
                channels = (1, 3, 4)[row["vec_id"] % 3]
                shape = (8, 8, channels) if row["vec_id"] % 2 == 0 else (4, 16, channels)
                pixels = np.stack([np.roll(levels, -c) for c in range(channels)], axis=1).astype(np.uint8)
                paths.append(f"{root}/{row['vec_id']}.png")
                with storage.open_output_stream(paths[-1]) as out:
                    out.write(_png(pixels.reshape(shape)))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(paths, pa.string())], ["vec_id", "path"])

    drawn = through_table(vectors.mapInArrow(draw, "vec_id bigint, path string"), "png-list")
    return folder, drawn


def _pam(pixels: np.ndarray) -> bytes:
    """A PAM file of a (height, width, channels) byte array with 1, 3 or 4 channels."""
    height, width, channels = pixels.shape
    kind = {1: "GRAYSCALE", 3: "RGB", 4: "RGB_ALPHA"}[channels]
    head = f"P7\nWIDTH {width}\nHEIGHT {height}\nDEPTH {channels}\nMAXVAL 255\nTUPLTYPE {kind}\nENDHDR\n"
    return head.encode() + pixels.tobytes()


def picture_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """PAM files drawn from the embeddings, one per vector, and their folder and (vec_id, path).

    Channel c of pixel i is element (i + c) mod 64, scaled to a byte. One in 25 is a line of 256
    pixels, one in 50 has lost its pixels.
    """
    folder = shared_path(spark, "pam")
    storage, root = open_storage(folder)
    vectors = spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                i = row["vec_id"]
                levels = np.floor(np.array(row["embedding"], np.float64) * 1000).astype(np.int64) % 256
                height, width = (1, 256) if i % 25 == 3 else (8, 8) if i % 2 == 0 else (4, 16)
                at = np.arange(height * width)[:, None] + np.arange((1, 3, 4)[i % 3])
                data = _pam(levels[at % 64].astype(np.uint8).reshape(height, width, -1))
                storage.create_dir(f"{root}/{i % 10}")
                paths.append(f"{root}/{i % 10}/{i}.pam")
                with storage.open_output_stream(paths[-1]) as out:
                    out.write(data[: data.index(b"ENDHDR")] if i % 50 == 7 else data)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(paths, pa.string())], ["vec_id", "path"])

    return root, through_table(vectors.mapInArrow(draw, "vec_id bigint, path string"), "pam-list")


def picture_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, images, messages) with references to the pictures, some of which do not exist."""
    doc = F.col("doc_id")

    def ref(k: Column) -> Column:
        number = (doc * 7 + k * 13) % 1100
        name = F.concat((number % 10).cast("string"), F.lit("/"), F.when(doc % 10 == 9, "gone").otherwise(""), number.cast("string"))
        return F.concat(F.lit(REMOTE), name, F.lit(".pam"))

    numbers = F.slice(F.array(*[F.lit(k).cast("bigint") for k in range(3)]), F.lit(1), (doc % 4).cast("int"))
    return examples(spark, sf_dir).withColumn("images", F.transform(numbers, ref))


def vec_id_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([0-9]+)[^/]*\.(?:png|pam)$", 1).cast("bigint")


def example_lines(spark: SparkSession, sf_dir: str) -> str:
    """The examples as JSON lines in the shared folder."""
    path = shared_path(spark, "jsonl")
    examples(spark, sf_dir).write.json(path)
    return path

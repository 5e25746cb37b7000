"""Queries over reads, writes and streams: what was written, as read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmark.operators import images as I
from stepmark.operators import messages as M
from stepmark.operators.batches import split_train_test
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query
from stepmark.plans.message_queries import messages_hash
from stepmark.schemas import EXAMPLE
from stepmark.session import shared_path
from stepmark.sources import (
    describe_columns,
    publish_version,
    scan_jsonl,
    scan_split,
    scan_table,
    verify_written,
    write_sharded,
)
from stepmark.streaming import stream_jsonl, stream_peek, stream_prepare, stream_regroup

KEYED = T.StructType([T.StructField("doc_id", T.LongType()), *EXAMPLE.fields])

_EXAMPLES = f"""WITH {sql.RENDERED}
SELECT r.doc_id, (doc_id % 4)::INTEGER AS n_images, text FROM rendered r"""


def summary(df):
    """Images and rendered text of examples."""
    messages = M.drop_empty_messages(M.clean_items_media_first(F.col("messages")))
    return df.select("doc_id", F.size("images").alias("n_images"), M.render_chat(messages).alias("text"))


@query("scan_jsonl", _EXAMPLES)
def read_lines(spark, sf_dir):
    return summary(scan_jsonl(spark, A.example_lines(spark, sf_dir), KEYED))


@query("scan_table", "SELECT * FROM conversations")
def read_table(spark, sf_dir):
    return scan_table(spark, f"{sf_dir}/conversations.parquet")


_SPLIT = """CASE WHEN ('0x' || substr(md5(concat(doc_id, '-42')), 1, 8))::BIGINT < 0.2 * 4294967296
            THEN 'test' ELSE 'train' END"""


def _published(spark, sf_dir):
    """The documents split and published; the folder and the manifest."""
    root = shared_path(spark, "published")
    docs = split_train_test(A.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 0.2)
    return root, publish_version(docs, root, "documents", "1", "doc_id"), docs


@query("scan_split", f"SELECT doc_id, text FROM documents WHERE {_SPLIT} = 'test'")
def read_split(spark, sf_dir):
    root, _, _ = _published(spark, sf_dir)
    return scan_split(spark, f"{root}/documents/v=1", "test").select("doc_id", "text")


@query(
    "publish_version",
    f"""SELECT {_SPLIT} AS split, count(*) AS num_rows, min(doc_id) AS min_key, max(doc_id) AS max_key, '1' AS version
FROM documents GROUP BY ALL""",
)
def manifest(spark, sf_dir):
    return _published(spark, sf_dir)[1].select("split", "num_rows", "min_key", "max_key", "version")


@query("write_sharded", "SELECT doc_id, text FROM documents")
def write_and_read(spark, sf_dir):
    path = shared_path(spark, "sharded")
    write_sharded(A.table(spark, sf_dir, "documents").select("doc_id", "text"), path, shards=4)
    return scan_table(spark, path)


@query("verify_written", f"SELECT doc_id FROM documents WHERE {_SPLIT} = 'test'")
def verify(spark, sf_dir):
    """Only one of the two splits is looked at, so the keys of the other are missing."""
    root, _, docs = _published(spark, sf_dir)
    written = scan_split(spark, f"{root}/documents/v=1", "train")
    return verify_written(docs, written, ["doc_id"], strict=False)


@query(
    "describe_columns",
    """SELECT column_name AS "column",
       CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type,
       (SELECT count(*) FROM documents) AS num_rows
FROM (DESCRIBE documents)""",
)
def describe(spark, sf_dir):
    return describe_columns(A.table(spark, sf_dir, "documents"))


def _stream_paths(spark):
    return shared_path(spark, "stream-out"), shared_path(spark, "stream-state")


@query(
    "stream_jsonl",
    f"WITH {sql.IMAGES} SELECT doc_id, uri AS image FROM imgs",
)
def stream_explode(spark, sf_dir):
    out, state = _stream_paths(spark)
    stream = stream_jsonl(spark, A.example_lines(spark, sf_dir), KEYED)
    explode = lambda df: df.select("doc_id", F.explode("images").alias("image"))
    stream_prepare(stream, explode, out, state).awaitTermination()
    return scan_table(spark, out)


@query("stream_prepare", _EXAMPLES)
def stream_render(spark, sf_dir):
    out, state = _stream_paths(spark)
    stream = stream_jsonl(spark, A.example_lines(spark, sf_dir), KEYED)
    stream_prepare(stream, summary, out, state).awaitTermination()
    return scan_table(spark, out)


@query(
    "stream_regroup",
    f"""WITH {sql.ITEMS}, {sql.IMAGES}, {sql.MESSAGES}
SELECT doc_id, any_value(messages) AS messages, coalesce(string_agg(l.path, ',' ORDER BY n), '') AS images
FROM hashes LEFT JOIN imgs USING (doc_id) LEFT JOIN listing l ON l.path = imgs.path GROUP BY doc_id""",
)
def stream_existing(spark, sf_dir):
    out, state = _stream_paths(spark)
    lines = shared_path(spark, "jsonl")
    A.local_examples(spark, sf_dir).write.json(lines)
    listing = A.listing(spark, sf_dir)
    stream_regroup(
        stream_jsonl(spark, lines, KEYED),
        lambda batch: I.keep_existing_images(batch, listing, "doc_id"),
        out,
        state,
    ).awaitTermination()
    return scan_table(spark, out).select(
        "doc_id", messages_hash(F.col("messages")).alias("messages"), F.array_join("images", ",").alias("images")
    )


@query("stream_peek", f"{_EXAMPLES} ORDER BY doc_id LIMIT 3")
def stream_first(spark, sf_dir):
    out, state = _stream_paths(spark)
    stream = stream_jsonl(spark, A.example_lines(spark, sf_dir), KEYED)
    return summary(stream_peek(stream, "doc_id", out, state))

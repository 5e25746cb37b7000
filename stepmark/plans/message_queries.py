"""Queries over examples and their messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmark.functions.text import trim_text
from stepmark.operators import examples as X
from stepmark.operators import messages as M
from stepmark.operators.batches import split_train_test
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query


def item_rows(df: DataFrame, messages: Column) -> DataFrame:
    """Messages as flat rows: place of the message and item, role, type, text, image."""
    return (
        df.select("doc_id", F.posexplode_outer(messages).alias("message_pos", "m"))
        .select("doc_id", "message_pos", "m.role", F.posexplode_outer("m.content").alias("item_pos", "i"))
        .where(F.col("item_pos").isNotNull())
        .select("doc_id", "message_pos", "role", "item_pos", "i.type", "i.text", "i.image")
    )


def messages_hash(messages: Column) -> Column:
    """One hash over all items of the messages, in order; a NULL part differs from an empty one."""

    def part(value: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))

    def item(message: Column, i: Column) -> Column:
        return F.concat_ws("|", message["role"], i["type"], part(i["text"]), part(i["image"]), part(i["index"]))

    items = F.flatten(F.transform(messages, lambda m: F.transform(m["content"], lambda i: item(m, i))))
    return F.md5(F.array_join(items, "\n"))


_USABLE_ROWS = """
SELECT doc_id, (dense_rank() OVER (PARTITION BY doc_id ORDER BY msg) - 1)::INTEGER AS message_pos, role,
       (row_number() OVER (PARTITION BY doc_id, msg ORDER BY {order}) - 1)::INTEGER AS item_pos,
       type, text, image
FROM {items}"""


@query(
    "clean_items_media_first",
    f"""WITH {sql.ITEMS}
SELECT doc_id, msg::INTEGER AS message_pos, role,
       (row_number() OVER (PARTITION BY doc_id, msg ORDER BY {sql.MEDIA_FIRST}) - 1)::INTEGER AS item_pos,
       type, text, image
FROM usable""",
)
def clean_items_media_first(spark, sf_dir):
    df = A.examples(spark, sf_dir)
    return item_rows(df, M.clean_items_media_first(F.col("messages")))


@query(
    "drop_empty_messages",
    f"WITH {sql.ITEMS}" + _USABLE_ROWS.format(order=sql.MEDIA_FIRST, items="usable"),
)
def drop_empty_messages(spark, sf_dir):
    df = A.examples(spark, sf_dir)
    return item_rows(df, M.drop_empty_messages(M.clean_items_media_first(F.col("messages"))))


@query(
    "resolve_image_index",
    f"WITH {sql.ITEMS}, {sql.IMAGES}, {sql.RESOLVED}" + _USABLE_ROWS.format(order="pos", items="resolved"),
)
def resolve_image_index(spark, sf_dir):
    df = A.examples(spark, sf_dir)
    return item_rows(df, M.resolve_image_index(F.col("messages"), F.col("images")))


@query(
    "dropped_index_report",
    """SELECT doc_id, 1 AS message_pos, 1 AS item_pos, (doc_id % 3)::INTEGER AS image_index
FROM documents WHERE doc_id % 3 >= doc_id % 4""",
)
def dropped_index_report(spark, sf_dir):
    return M.dropped_index_report(A.examples(spark, sf_dir), "doc_id")


@query(
    "flatten_message_images",
    f"""WITH {sql.IMAGES} SELECT d.doc_id, coalesce(uri, '') AS images
FROM documents d LEFT JOIN imgs g ON g.doc_id = d.doc_id AND g.n = d.doc_id % 3""",
)
def flatten_message_images(spark, sf_dir):
    df = A.examples(spark, sf_dir)
    flat = M.flatten_message_images(M.resolve_image_index(F.col("messages"), F.col("images")))
    return df.select("doc_id", F.array_join(flat, ",").alias("images"))


@query("render_chat", f"WITH {sql.RENDERED} SELECT doc_id, text FROM rendered")
def render_chat(spark, sf_dir):
    return A.rendered(spark, sf_dir)


@query(
    "trim_text",
    f"""WITH {sql.ITEMS}, {sql.IMAGES}, {sql.RESOLVED}, {sql.render("resolved", "pos", "rendered")}
SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM rendered""",
)
def trimmed(spark, sf_dir):
    df = A.examples(spark, sf_dir)
    messages = M.resolve_image_index(F.col("messages"), F.col("images"))
    return df.select("doc_id", trim_text(M.render_chat(messages)).alias("text"))



@query(
    "rewrite_prefix",
    f"""WITH {sql.IMAGES} SELECT doc_id, coalesce(string_agg(path, ',' ORDER BY n), '') AS images
FROM documents LEFT JOIN imgs USING (doc_id) GROUP BY doc_id""",
)
def rewrite_prefix(spark, sf_dir):
    df = A.image_examples(spark, sf_dir)
    local = A.rewrite_prefix(F.col("images"), A.REMOTE, A.BASE)
    return df.select("doc_id", F.array_join(local, ",").alias("images"))


_WITH_MESSAGES = f"WITH {sql.ITEMS}, {sql.IMAGES}, {sql.MESSAGES}"


def hashed(df: DataFrame) -> DataFrame:
    """Messages as one hash over all of them."""
    return df.withColumn("messages", messages_hash(F.col("messages")))


@query(
    "explode_images",
    f"{_WITH_MESSAGES} SELECT doc_id, messages, uri AS image FROM imgs JOIN hashes USING (doc_id)",
)
def explode_images(spark, sf_dir):
    return hashed(X.explode_images(A.examples(spark, sf_dir)))


@query(
    "last_image",
    f"""{_WITH_MESSAGES} SELECT d.doc_id, messages, uri AS image
FROM hashes d LEFT JOIN imgs g ON g.doc_id = d.doc_id AND g.n = d.doc_id % 4 - 1""",
)
def last_image(spark, sf_dir):
    return hashed(X.last_image(A.examples(spark, sf_dir)))


@query(
    "first_image",
    f"""{_WITH_MESSAGES} SELECT d.doc_id, messages, uri AS image
FROM hashes d LEFT JOIN imgs g ON g.doc_id = d.doc_id AND g.n = 0""",
)
def first_image(spark, sf_dir):
    return hashed(X.first_image(A.examples(spark, sf_dir)))


@query(
    "wrap_image",
    f"""{_WITH_MESSAGES} SELECT d.doc_id, messages, 1 AS n_images, coalesce(uri, '') AS images
FROM hashes d LEFT JOIN imgs g ON g.doc_id = d.doc_id AND g.n = 0""",
)
def wrap_image(spark, sf_dir):
    wrapped = hashed(X.wrap_image(X.first_image(A.examples(spark, sf_dir))))
    return wrapped.select(
        "doc_id", "messages", F.size("images").alias("n_images"), F.array_join("images", ",").alias("images")
    )


@query(
    "project_example",
    f"{_WITH_MESSAGES} SELECT path AS image, messages FROM imgs JOIN hashes USING (doc_id)",
)
def project_example(spark, sf_dir):
    return hashed(X.project_example(X.explode_images(A.local_examples(spark, sf_dir))))


@query(
    "tag_split",
    f"{_WITH_MESSAGES} SELECT uri AS image, messages, 'train' AS split FROM imgs JOIN hashes USING (doc_id)",
)
def tag_split(spark, sf_dir):
    return hashed(X.tag_split(X.explode_images(A.examples(spark, sf_dir)))).select("image", "messages", "split")


@query(
    "count_examples",
    """SELECT CASE WHEN ('0x' || substr(md5(concat(doc_id, '-7')), 1, 8))::BIGINT < 0.2 * 4294967296
            THEN 'test' ELSE 'train' END AS split, count(*) AS num_rows
FROM documents GROUP BY ALL""",
)
def count_examples(spark, sf_dir):
    return X.count_examples(split_train_test(A.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.2, 7))


@query(
    "example_key",
    f"""{_WITH_MESSAGES},
rows AS (SELECT doc_id, messages, unnest(range(1 + (doc_id % 3 = 0)::INTEGER + (doc_id = 0)::INTEGER * 5)) AS ordinal FROM hashes)
SELECT doc_id, messages, ordinal, 1::BIGINT AS n_hashes FROM rows""",
)
def example_key(spark, sf_dir):
    """Whole examples with their messages, one in three of them twice, one seven times."""
    examples = A.examples(spark, sf_dir)
    again = examples.where("doc_id % 3 = 0")
    often = examples.where("doc_id = 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("_")
    keyed = hashed(X.example_key(examples.unionByName(again).unionByName(often), rows_per_block=4))
    hashes = keyed.groupBy("doc_id").agg(F.count_distinct("row_hash").alias("n_hashes"))
    return keyed.select("doc_id", "messages", "ordinal").join(hashes, "doc_id")


@query("peek_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 3")
def peek_n(spark, sf_dir):
    return X.peek_n(A.table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")

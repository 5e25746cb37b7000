"""Queries over order, splits, batches and training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepmark.functions import labels as L
from stepmark.functions.numbers import cosine_similarity
from stepmark.operators import batches as B
from stepmark.operators import metrics as G
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query
from stepmark.plans.token_queries import joined

_BATCH = """
  idx // 2 AS micro_batch, idx // 512 AS step, ((idx // 16) % 32)::INTEGER AS slot,
  ((idx // 2) % 8)::INTEGER AS device, (idx % 2)::INTEGER AS position"""


def docs(spark, sf_dir):
    return A.table(spark, sf_dir, "documents")


@query(
    "global_index",
    f"WITH {sql.ORDERED} SELECT doc_id, text, idx FROM ordered JOIN documents USING (doc_id)",
)
def global_index(spark, sf_dir):
    return B.global_index(docs(spark, sf_dir).select("doc_id", "text"), "doc_id")


@query(
    "seeded_shuffle",
    "SELECT doc_id, md5(concat(doc_id, '-42-1')) AS order_key, text FROM documents ORDER BY order_key, doc_id",
)
def seeded_shuffle(spark, sf_dir):
    df = docs(spark, sf_dir).select("doc_id", "text")
    ordered = B.seeded_shuffle(df, "doc_id", epoch=1)
    return ordered.select("doc_id", B.seeded_hash(F.col("doc_id"), 42, 1).alias("order_key"), "text")


@query("assign_batch", f"WITH {sql.ORDERED} SELECT doc_id, idx, {_BATCH} FROM ordered")
def assign_batch(spark, sf_dir):
    return B.assign_batch(B.global_index(docs(spark, sf_dir).select("doc_id"), "doc_id"))


@query(
    "limit_steps",
    f"WITH {sql.ORDERED} SELECT doc_id, idx, {_BATCH} FROM ordered WHERE idx // 512 < 1",
)
def limit_steps(spark, sf_dir):
    batches = B.assign_batch(B.global_index(docs(spark, sf_dir).select("doc_id"), "doc_id"))
    return B.limit_steps(batches, 1)


@query(
    "group_by_length",
    f"""WITH {sql.ORDERED}
SELECT doc_id, n_chars, (idx // 128) * 128 + row_number() OVER (
  PARTITION BY idx // 128 ORDER BY n_chars DESC, md5(concat(doc_id, '-42')), doc_id) - 1 AS idx
FROM ordered JOIN documents USING (doc_id)""",
)
def group_by_length(spark, sf_dir):
    indexed = B.global_index(docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    return B.group_by_length(indexed, "n_chars", "doc_id", block_rows=128)


@query(
    "repeat_epochs",
    """SELECT doc_id, epoch::INTEGER AS epoch, row_number() OVER (
  PARTITION BY epoch ORDER BY md5(concat(doc_id, '-42-', epoch)), doc_id) - 1 AS idx
FROM documents, range(2) t(epoch)""",
)
def repeat_epochs(spark, sf_dir):
    repeated = B.repeat_epochs(docs(spark, sf_dir).select("doc_id"), 2)
    return B.global_index(repeated, "doc_id", epoch="epoch")


@query(
    "dataset_mix",
    """SELECT 'documents' AS dataset, doc_id AS key, text FROM documents
UNION ALL
SELECT 'pages', page_id, html FROM pages
WHERE ('0x' || substr(md5(concat('pages-', page_id, '-42')), 1, 8))::BIGINT / 4294967296 < 0.25""",
)
def dataset_mix(spark, sf_dir):
    documents = docs(spark, sf_dir).select(F.col("doc_id").alias("key"), "text")
    pages = A.table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), F.col("html").alias("text"))
    return B.dataset_mix({"documents": (documents, "key", 1.0), "pages": (pages, "key", 0.25)})


@query(
    "split_train_test",
    """SELECT doc_id, text, CASE WHEN ('0x' || substr(md5(concat(doc_id, '-7')), 1, 8))::BIGINT < 0.2 * 4294967296
       THEN 'test' ELSE 'train' END AS split FROM documents""",
)
def split_train_test(spark, sf_dir):
    return B.split_train_test(docs(spark, sf_dir).select("doc_id", "text"), "doc_id", 0.2, seed=7)


def batched(spark, sf_dir):
    """(doc_id, ids) with their batch, the padding id, and the ids of the marks."""
    df, vocab = A.encoded(spark, sf_dir)
    return B.assign_batch(B.global_index(df, "doc_id")), A.pad_id_of(vocab), list(A.mark_ids(vocab))


def padded_sql(labels: str) -> str:
    """CTEs that end in padded(doc_id, idx, ids, labels) from a table of ids and labels."""
    return f"""
sizes AS (SELECT doc_id, count(*) AS n FROM {labels} GROUP BY doc_id),
longest AS (
  SELECT doc_id, idx, n, max(n) OVER (PARTITION BY idx // 2) AS m FROM ordered JOIN sizes USING (doc_id)
),
padded AS (
  SELECT doc_id, idx,
         string_agg(id, ',' ORDER BY pos) || repeat(',' || {sql.PAD_ID}, (m - n)::INTEGER) AS ids,
         string_agg(label, ',' ORDER BY pos) || repeat(',-100', (m - n)::INTEGER) AS labels
  FROM {labels} JOIN longest USING (doc_id) GROUP BY doc_id, idx, m, n
)"""


def flat_rows(column: str):
    """A list of lists as text."""
    return F.array_join(F.transform(column, lambda r: F.array_join(r.cast("array<string>"), ",")), ";")


@query(
    "pad_to_longest",
    f"""WITH {sql.ENCODED}, {sql.ORDERED}, {padded_sql("lab")}
SELECT doc_id, idx // 2 AS micro_batch, ids, labels FROM padded""",
)
def pad_to_longest(spark, sf_dir):
    """Labels are made from the padded ids, so ids alone are shuffled."""
    df, pad_id, marks = batched(spark, sf_dir)
    padded = B.pad_to_longest(df, pad_id).withColumn("labels", L.mask_keep(F.col("ids"), marks))
    return padded.select("doc_id", "micro_batch", joined("ids").alias("ids"), joined("labels").alias("labels"))


@query(
    "batch_collate",
    f"""WITH {sql.ENCODED}, {sql.ORDERED}, {sql.IMAGES}, {padded_sql("lab")},
pictures AS (
  SELECT doc_id, coalesce(string_agg(uri, ',' ORDER BY n), '') AS images FROM documents LEFT JOIN imgs USING (doc_id) GROUP BY doc_id
)
SELECT idx // 2 AS micro_batch, string_agg(doc_id, ',' ORDER BY idx) AS keys, string_agg(ids, ';' ORDER BY idx) AS input_ids,
       string_agg(labels, ';' ORDER BY idx) AS labels, string_agg(images, ';' ORDER BY idx) AS images
FROM padded JOIN pictures USING (doc_id) GROUP BY idx // 2""",
)
def batch_collate(spark, sf_dir):
    df, pad_id, marks = batched(spark, sf_dir)
    padded = B.pad_to_longest(df, pad_id).withColumn("labels", L.mask_keep(F.col("ids"), marks))
    pictures = padded.withColumn("images", A.image_uris(F.col("doc_id")))
    collated = B.batch_collate(pictures, key="doc_id", images="images")
    return collated.select(
        "micro_batch",
        F.array_join(F.col("keys").cast("array<string>"), ",").alias("keys"),
        *[flat_rows(c).alias(c) for c in ("input_ids", "labels", "images")],
    )


@query(
    "run_throughput",
    f"""WITH {sql.RUN_LOG},
runs AS (
  SELECT run_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS runtime,
         count(*) AS steps, avg(loss) AS mean_loss
  FROM log GROUP BY run_id
)
SELECT run_id, round(runtime, 6) AS runtime, steps, round(mean_loss, 9) AS mean_loss,
       round(steps / nullif(runtime, 0), 9) AS steps_per_second,
       round(steps / nullif(runtime, 0) * 8, 9) AS samples_per_second
FROM runs""",
)
def run_throughput(spark, sf_dir):
    result = G.run_throughput(A.raw_log(spark, sf_dir), samples_per_step=8)
    places = {"runtime": 6, "mean_loss": 9, "steps_per_second": 9, "samples_per_second": 9}
    return result.withColumns({c: F.round(c, n) for c, n in places.items()})


@query(
    "metric_every_n",
    f"""WITH {sql.RUN_LOG}
SELECT run_id, step // 10 AS "window", round(avg(loss), 6) AS mean_loss, count(*) AS steps
FROM log GROUP BY run_id, step // 10""",
)
def metric_every_n(spark, sf_dir):
    return G.metric_every_n(A.run_log(spark, sf_dir)).withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "rolling_metric",
    f"""WITH {sql.RUN_LOG}
SELECT run_id, step, round(avg(loss) OVER (
  PARTITION BY run_id ORDER BY step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS rolling_loss
FROM log""",
)
def rolling_metric(spark, sf_dir):
    rolling = G.rolling_metric(A.run_log(spark, sf_dir))
    return rolling.select("run_id", "step", F.round("rolling_loss", 6).alias("rolling_loss"))


@query(
    "cosine_similarity",
    """SELECT a.vec_id, round(
  list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine(spark, sf_dir):
    vectors = A.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    pairs = vectors.join(following, "vec_id")
    return pairs.select("vec_id", F.round(cosine_similarity(F.col("embedding"), F.col("next")), 6).alias("cosine"))

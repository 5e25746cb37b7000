"""Queries that run a whole flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepmark.functions.text import BAD, GOOD, IMAGE
from stepmark.operators.hooks import map_batches
from stepmark.operators.images import attach_media
from stepmark.operators.tokens import token_ids
from stepmark.plans import adapters as A
from stepmark.plans import flows, sql
from stepmark.plans.batch_queries import flat_rows, padded_sql
from stepmark.plans.catalog import query
from stepmark.plans.message_queries import messages_hash

_BATCHES = """
SELECT idx // 2 AS micro_batch, string_agg(doc_id, ',' ORDER BY idx) AS keys, string_agg(ids, ';' ORDER BY idx) AS input_ids,
       string_agg(labels, ';' ORDER BY idx) AS labels, string_agg(images, ';' ORDER BY idx) AS images
FROM padded JOIN pictures USING (doc_id) GROUP BY idx // 2"""


def flat_batches(batches):
    """Batches in full, each list as text."""
    return batches.select(
        "micro_batch",
        F.array_join(F.col("keys").cast("array<string>"), ",").alias("keys"),
        *[flat_rows(c).alias(c) for c in ("input_ids", "labels", "images")],
    )


@query(
    "training_batches",
    f"""WITH {sql.ENCODED}, {sql.ORDERED}, {sql.IMAGES}, {padded_sql("lab")},
pictures AS (
  SELECT doc_id, coalesce(string_agg(uri, ',' ORDER BY n), '') AS images FROM documents LEFT JOIN imgs USING (doc_id) GROUP BY doc_id
)
{_BATCHES}""",
)
def training_batches(spark, sf_dir):
    examples = A.examples(spark, sf_dir)
    vocab = A.corpus_vocab(flows.rendered_text(examples))
    marks = token_ids(vocab, [GOOD, BAD])
    batches = flows.training_batches(
        examples, vocab, "doc_id", list(marks.values()), A.pad_id_of(vocab), images="images", expected=marks
    )
    return flat_batches(batches)


@query(
    "indexed_batches",
    f"""WITH {sql.VOCAB}, {sql.IMAGES}, {sql.RESOLVED}, {sql.render("resolved", "pos", "other")},
tok2 AS (
  SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, regexp_extract_all(
    trim(text, ' ' || chr(9) || chr(10) || chr(13)), '{sql.TOKEN_PATTERN}', 1) AS t FROM other)),
lab AS (
  SELECT doc_id, pos, coalesce(token_id, -1) AS id, CASE WHEN token = '<image>' THEN -100 ELSE coalesce(token_id, -1) END AS label
  FROM tok2 LEFT JOIN vocab USING (token)),
{sql.ORDERED}, {padded_sql("lab")},
pictures AS (
  SELECT d.doc_id, coalesce(uri, '') AS images
  FROM documents d LEFT JOIN imgs g ON g.doc_id = d.doc_id AND g.n = d.doc_id % 3
)
{_BATCHES}""",
)
def indexed_batches(spark, sf_dir):
    examples = A.examples(spark, sf_dir)
    vocab = A.corpus_vocab(flows.rendered_text(examples))
    image = token_ids(vocab, [IMAGE])
    return flat_batches(
        flows.indexed_batches(examples, vocab, "doc_id", list(image.values()), A.pad_id_of(vocab), expected=image)
    )


@query(
    "converted_table",
    f"""WITH {sql.ITEMS}, {sql.IMAGES}, {sql.MESSAGES}
SELECT path AS image, messages, 'train' AS split FROM imgs JOIN hashes USING (doc_id)""",
)
def converted_table(spark, sf_dir):
    """With a listing that has every image, so that the strict check passes."""
    everything = A.local_examples(spark, sf_dir).select(F.explode("images").alias("path"))
    table = flows.converted_table(A.examples(spark, sf_dir), everything, A.REMOTE, A.BASE)
    return table.select("image", messages_hash(F.col("messages")).alias("messages"), "split")


def _resized(spark, sf_dir):
    """The resize flow over the examples with pictures, and the folder of the pictures."""
    folder, _ = A.picture_files(spark, sf_dir)
    return flows.resized_table(A.picture_examples(spark, sf_dir), "doc_id", A.REMOTE, folder + "/", strict=False), folder


_PICKED = f"WITH {sql.ITEMS}, {sql.MESSAGES}, {sql.picked('')}"


@query(
    "resized_table",
    f"""{_PICKED}
SELECT doc_id, '/' || (n % 10) || '/' || n || '_resized.pam' AS image, messages, 'train' AS split
FROM outcome WHERE reason IS NULL""",
)
def resized_examples(spark, sf_dir):
    resized, folder = _resized(spark, sf_dir)
    name = F.replace(F.replace("image", F.lit(folder), F.lit("")), F.lit("//"), F.lit("/"))
    return resized.examples.select(
        "doc_id", name.alias("image"), messages_hash(F.col("messages")).alias("messages"), "split"
    )


@query(
    "resized_rejects",
    f"{_PICKED} SELECT doc_id::VARCHAR AS example_key, 'image' AS stage, reason FROM outcome WHERE reason IS NOT NULL",
)
def resized_rejects(spark, sf_dir):
    resized, folder = _resized(spark, sf_dir)
    name = F.replace(F.replace("reason", F.lit(folder), F.lit("")), F.lit("//"), F.lit("/"))
    return resized.rejects.withColumn("reason", name)


@query(
    "resized_images",
    f"""{_PICKED}, used AS (SELECT DISTINCT n FROM outcome WHERE reason IS NULL),
sides AS (
  SELECT n, CASE WHEN n % 2 = 0 THEN 8 ELSE 4 END AS height, CASE WHEN n % 2 = 0 THEN 8 ELSE 16 END AS width FROM used),
planned AS (SELECT n, {sql.planned_side("height")} AS h, {sql.planned_side("width")} AS w FROM sides)
SELECT n AS vec_id, h::INTEGER AS height, w::INTEGER AS width, (h * w * 3)::INTEGER AS n_bytes FROM planned""",
)
def resized_images(spark, sf_dir):
    """Only the pictures that an example picked are there, once each."""
    resized, _ = _resized(spark, sf_dir)
    return resized.images.select(
        A.vec_id_of(F.col("path")).alias("vec_id"), "height", "width", F.octet_length("data").alias("n_bytes")
    )


def _picture_batches(spark, sf_dir):
    examples = A.picture_examples(spark, sf_dir)
    folder, _ = A.picture_files(spark, sf_dir)
    local = examples.withColumn("images", A.rewrite_prefix(F.col("images"), A.REMOTE, folder))
    vocab = A.corpus_vocab(flows.rendered_text(examples))
    marks = token_ids(vocab, [GOOD, BAD])
    return flows.training_batches(local, vocab, "doc_id", list(marks.values()), A.pad_id_of(vocab), images="images")


_REFS = """
refs AS (
  SELECT doc_id, k, (doc_id * 7 + k * 13) % 1100 AS n, doc_id % 10 = 9 AS gone FROM documents, range(3) t(k) WHERE k < doc_id % 4
)"""


@query(
    "batch_media",
    f"""WITH {sql.ORDERED}, {sql.PICTURES}, {_REFS},
files AS (
  SELECT doc_id, string_agg(CASE WHEN gone THEN 'gone' ELSE '' END || n || ':'
                            || coalesce(CASE WHEN NOT gone THEN md5(bytes) END, '-'), ',' ORDER BY k) AS files
  FROM refs LEFT JOIN picture_bytes ON vec_id = n GROUP BY doc_id)
SELECT idx // 2 AS micro_batch, string_agg(coalesce(files, ''), ';' ORDER BY idx) AS media
FROM ordered LEFT JOIN files USING (doc_id) GROUP BY idx // 2""",
)
def batch_media(spark, sf_dir):
    """The files of each row of each batch, read by reference after batching."""
    batches = attach_media(_picture_batches(spark, sf_dir).select("micro_batch", "images"))

    def file(f):
        return F.concat_ws(":", F.regexp_extract(f["path"], r"([^/]*)\.pam$", 1), F.coalesce(F.md5(F.hex(f["bytes"])), F.lit("-")))

    rows = F.transform("media", lambda row: F.array_join(F.transform(row, file), ","))
    return batches.select("micro_batch", F.array_join(rows, ";").alias("media"))


def count_labels():
    """A batch function: how many ids, padding included, and the sum of the labels that count."""

    def process(batch):
        counting = [x for row in batch["labels"] for x in row if x != -100]
        return {
            "micro_batch": batch["micro_batch"],
            "n_ids": sum(map(len, batch["input_ids"])),
            "n_counting": len(counting),
            "label_sum": sum(counting),
            "first_key": batch["keys"][0],
        }

    return process


@query(
    "map_batches",
    f"""WITH {sql.ENCODED}, {sql.ORDERED},
sizes AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (label <> -100) AS counting, coalesce(sum(label) FILTER (label <> -100), 0) AS total
  FROM lab GROUP BY doc_id)
SELECT idx // 2 AS micro_batch, (max(n) * count(*))::BIGINT AS n_ids, sum(counting)::BIGINT AS n_counting,
       sum(total)::BIGINT AS label_sum, arg_min(doc_id, idx) AS first_key
FROM sizes JOIN ordered USING (doc_id) GROUP BY idx // 2""",
)
def batch_function(spark, sf_dir):
    """A user's function over whole batches."""
    schema = "micro_batch bigint, n_ids bigint, n_counting bigint, label_sum bigint, first_key bigint"
    examples = A.examples(spark, sf_dir)
    vocab = A.corpus_vocab(flows.rendered_text(examples))
    batches = flows.training_batches(examples, vocab, "doc_id", list(A.mark_ids(vocab)), A.pad_id_of(vocab))
    return map_batches(batches, count_labels, schema)

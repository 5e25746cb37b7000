"""Queries over image references, image files and pixels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.functions import refs as R
from stepmark.functions.sizes import aspect_ratio_reject
from stepmark.operators import examples as X
from stepmark.operators import hooks as H
from stepmark.operators import images as I
from stepmark.operators.rejects import reference_reason, reject_table, rejects
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query
from stepmark.plans.message_queries import messages_hash
from stepmark.sources import list_files, read_files, scan_image_files, scan_images

_REFS = """
refs AS (
  SELECT page_id, CASE page_id % 5
    WHEN 0 THEN 'file:///data/page ' || page_id || '.png'
    WHEN 1 THEN 'data:image/png;base64,' || to_base64(encode(html))
    WHEN 2 THEN 'data:image/svg+xml,' || html
    WHEN 3 THEN '/data/v.' || page_id || '/page.tar.gz'
    ELSE url END AS ref
  FROM pages
)"""


def page_refs(spark, sf_dir) -> DataFrame:
    """(page_id, ref): references of every kind; one in five pages keeps its own address."""
    page = F.col("page_id")
    number = page.cast("string")
    one_line = F.translate(F.base64(F.encode("html", "UTF-8")), "\r\n", "")
    return A.table(spark, sf_dir, "pages").select(
        page,
        F.when(page % 5 == 0, F.concat(F.lit("file:///data/page "), number, F.lit(".png")))
        .when(page % 5 == 1, F.concat(F.lit("data:image/png;base64,"), one_line))
        .when(page % 5 == 2, F.concat(F.lit("data:image/svg+xml,"), "html"))
        .when(page % 5 == 3, F.concat(F.lit("/data/v."), number, F.lit("/page.tar.gz")))
        .otherwise(F.col("url"))
        .alias("ref"),
    )


@query(
    "classify_image_ref",
    f"""WITH {_REFS} SELECT page_id, CASE WHEN regexp_matches(ref, '^https?://') THEN 'http'
  WHEN starts_with(ref, 'file://') THEN 'file'
  WHEN starts_with(ref, 'data:image') THEN CASE WHEN contains(ref, 'base64,') THEN 'data' ELSE 'unrecognized' END
  ELSE 'path' END AS kind FROM refs""",
)
def classify_image_ref(spark, sf_dir):
    return page_refs(spark, sf_dir).select("page_id", R.classify_image_ref(F.col("ref")).alias("kind"))


@query(
    "strip_file_scheme",
    f"""WITH {_REFS}
SELECT page_id, CASE WHEN starts_with(ref, 'file://') THEN substr(ref, 8) ELSE ref END AS path FROM refs""",
)
def strip_file_scheme(spark, sf_dir):
    return page_refs(spark, sf_dir).select("page_id", R.strip_file_scheme(F.col("ref")).alias("path"))


@query(
    "decode_data_uri",
    """SELECT page_id, CASE WHEN page_id % 5 = 1 THEN md5(html) END AS content,
       CASE WHEN page_id % 5 = 1 THEN strlen(html) END::INTEGER AS length FROM pages""",
)
def decode_data_uri(spark, sf_dir):
    content = page_refs(spark, sf_dir).select("page_id", R.decode_data_uri(F.col("ref")).alias("bytes"))
    return content.select(
        "page_id", F.md5("bytes").alias("content"), F.octet_length("bytes").alias("length")
    )


@query(
    "derive_resized_path",
    f"""WITH {_REFS}, paths AS (
  SELECT page_id, CASE WHEN starts_with(ref, 'file://') THEN substr(ref, 8) ELSE ref END AS path
  FROM refs WHERE page_id % 5 IN (0, 3)
)
SELECT page_id, regexp_replace(path, '(\\.[^./]*)$', '_resized\\1') AS path FROM paths""",
)
def derive_resized_path(spark, sf_dir):
    ref = F.col("ref")
    local = page_refs(spark, sf_dir).where(R.classify_image_ref(ref).isin("path", "file"))
    return local.select("page_id", R.derive_resized_path(R.strip_file_scheme(ref)).alias("path"))


@query(
    "reject_table",
    f"""WITH {_REFS}, {sql.DIMS}, {sql.IMAGES}
SELECT page_id::VARCHAR AS example_key, 'reference' AS stage,
       CASE page_id % 5 WHEN 2 THEN 'unrecognized reference: ' ELSE 'remote reference: ' END || ref AS reason
FROM refs WHERE page_id % 5 IN (2, 4)
UNION ALL
SELECT doc_id::VARCHAR, 'image', 'no image' FROM documents WHERE doc_id % 4 = 0
UNION ALL
SELECT l_orderkey || '-' || l_linenumber, 'size', 'aspect ratio' FROM dims
WHERE greatest(height, width)::DOUBLE / least(height, width) > 200""",
)
def all_rejects(spark, sf_dir):
    refs = page_refs(spark, sf_dir)
    kind = R.classify_image_ref(F.col("ref"))
    no_image = F.when(F.col("image").isNull(), "no image")
    extreme = F.when(aspect_ratio_reject(F.col("height"), F.col("width")), "aspect ratio")
    line = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return reject_table(
        rejects(refs, F.col("page_id"), "reference", reference_reason(F.col("ref"), kind)),
        rejects(X.last_image(A.image_examples(spark, sf_dir)), F.col("doc_id"), "image", no_image),
        rejects(A.dims(spark, sf_dir), line, "size", extreme),
    )


def local_images(spark, sf_dir):
    df = A.image_examples(spark, sf_dir)
    return df.withColumn("images", R.rewrite_prefix(F.col("images"), A.REMOTE, A.BASE))


@query(
    "missing_images_strict",
    f"""WITH {sql.IMAGES}
SELECT path, count(*) AS n_refs FROM imgs WHERE path NOT IN (SELECT path FROM listing) GROUP BY path""",
)
def missing_images(spark, sf_dir):
    return I.missing_images_strict(local_images(spark, sf_dir), A.listing(spark, sf_dir), strict=False)


@query(
    "keep_existing_images",
    f"""WITH {sql.ITEMS}, {sql.IMAGES}, {sql.MESSAGES}
SELECT doc_id, any_value(messages) AS messages, count(l.path)::INTEGER AS n_images,
       coalesce(string_agg(l.path, ',' ORDER BY n), '') AS images
FROM hashes LEFT JOIN imgs USING (doc_id) LEFT JOIN listing l ON l.path = imgs.path GROUP BY doc_id""",
)
def keep_existing_images(spark, sf_dir):
    kept = I.keep_existing_images(A.local_examples(spark, sf_dir), A.listing(spark, sf_dir), "doc_id")
    return kept.select(
        "doc_id",
        messages_hash(F.col("messages")).alias("messages"),
        F.size("images").alias("n_images"),
        F.array_join("images", ",").alias("images"),
    )


@query(
    "keep_readable_images",
    f"""WITH {sql.ITEMS}, {sql.MESSAGES},
refs AS (
  SELECT doc_id, k, n FROM (SELECT doc_id, k, (doc_id * 7 + k * 13) % 1100 AS n FROM documents, range(3) t(k) WHERE k < doc_id % 4)
  WHERE doc_id % 10 <> 9 AND n % 50 <> 7 AND n IN (SELECT vec_id FROM embeddings))
SELECT doc_id, any_value(messages) AS messages, count(n)::INTEGER AS n_images, coalesce(string_agg(n, ',' ORDER BY k), '') AS images
FROM hashes LEFT JOIN refs USING (doc_id) GROUP BY doc_id""",
)
def keep_readable_images(spark, sf_dir):
    """Missing files are dropped, and those that lost their pixels."""
    folder, _ = A.picture_files(spark, sf_dir)
    local = A.picture_examples(spark, sf_dir).withColumn("images", A.rewrite_prefix(F.col("images"), A.REMOTE, folder))
    refs = local.select(F.explode("images").alias("path"))
    kept = I.keep_existing_images(local, I.readable_images(refs), "doc_id")
    names = F.transform("images", lambda p: F.regexp_extract(p, r"([0-9]+)\.pam$", 1))
    return kept.select(
        "doc_id",
        messages_hash(F.col("messages")).alias("messages"),
        F.size("images").alias("n_images"),
        F.array_join(names, ",").alias("images"),
    )


@query(
    "scan_image_files",
    f"""WITH {sql.PICTURES}
SELECT vec_id, length(bytes) // 2 AS length, md5(bytes) AS content FROM picture_bytes""",
)
def image_files_read(spark, sf_dir):
    """Every byte of every file, listed and read by tasks."""
    folder, _ = A.picture_files(spark, sf_dir)
    files = scan_image_files(spark, folder)
    return files.select(
        A.vec_id_of(F.col("path")).alias("vec_id"), "length", F.md5(F.hex("content")).alias("content")
    )


@query("list_files", f"WITH {sql.PICTURES} SELECT vec_id, length(bytes) // 2 AS length FROM picture_bytes")
def files_listed(spark, sf_dir):
    folder, _ = A.picture_files(spark, sf_dir)
    return list_files(spark, folder).select(A.vec_id_of(F.col("path")).alias("vec_id"), "length")


@query(
    "scan_images",
    f"WITH {sql.PIXELS} SELECT vec_id, height, width, [1, 3, 4][kind + 1] AS channels FROM img",
)
def decoded_images(spark, sf_dir):
    folder, _ = A.image_files(spark, sf_dir)
    return scan_images(spark, folder).select(
        A.vec_id_of(F.col("path")).alias("vec_id"), "height", "width", "channels"
    )


@query(
    "attach_image_bytes",
    f"""WITH {sql.PICTURES}
SELECT vec_id, copy, CASE WHEN copy = 0 THEN md5(bytes) END AS content, copy = 1 AS is_missing
FROM picture_bytes, (VALUES (0), (1), (0)) c(copy)""",
)
def attach_image_bytes(spark, sf_dir):
    """Every image twice by its path and once by a path that does not exist."""
    _, drawn = A.picture_files(spark, sf_dir)
    real = F.struct(F.lit(0).alias("copy"), F.col("path").alias("image"))
    gone = F.struct(F.lit(1).alias("copy"), F.concat("path", F.lit(".gone")).alias("image"))
    refs = drawn.select("vec_id", F.explode(F.array(real, gone, real)).alias("c")).select("vec_id", "c.copy", "c.image")
    attached = I.attach_image_bytes(refs, ["vec_id", "copy"])
    missing = F.coalesce(F.col("image_reason").startswith("not found"), F.lit(False))
    return attached.select("vec_id", "copy", F.md5(F.hex("image.bytes")).alias("content"), missing.alias("is_missing"))


@query(
    "decode_images",
    f"""WITH {sql.PICTURES},
pixels AS (SELECT vec_id, string_agg(lpad(upper(to_hex(v)), 2, '0'), '' ORDER BY i, c) AS p FROM rgb GROUP BY vec_id)
SELECT vec_id, CASE WHEN p IS NOT NULL THEN height END AS height, CASE WHEN p IS NOT NULL THEN width END AS width,
       md5(p) AS pixels, CASE WHEN p IS NULL THEN 'not an image' END AS reason
FROM pic LEFT JOIN pixels USING (vec_id)""",
)
def decode_images(spark, sf_dir):
    folder, _ = A.picture_files(spark, sf_dir)
    rgb = I.decode_images(read_files(list_files(spark, folder)))
    return rgb.select(
        A.vec_id_of(F.col("path")).alias("vec_id"),
        "height",
        "width",
        F.md5(F.hex("data")).alias("pixels"),
        F.substring_index("reason", ":", 1).alias("reason"),
    )


def quadrant_sums():
    """A processor factory: the sums of the four quarters of an image, per channel."""

    def process(pixels):
        out = np.zeros((2, 2, 3), dtype=np.float32)
        rows, columns = (np.arange(n) * 2 // n for n in pixels.shape[:2])
        np.add.at(out, (rows[:, None], columns[None, :]), pixels.astype(np.float32))
        return out

    return process


@query(
    "image_features",
    f"""WITH {sql.PICTURES},
cells AS (
  SELECT vec_id, q // 6 AS r, (q // 3) % 2 AS k, q % 3 AS c, q FROM pic, range(12) t(q) WHERE vec_id % 50 <> 7),
sums AS (
  SELECT vec_id, (i // width) * 2 // height AS r, (i % width) * 2 // width AS k, c, sum(v) AS s FROM rgb GROUP BY ALL)
SELECT p.vec_id, string_agg(coalesce(s, 0)::BIGINT, ',' ORDER BY q) AS features
FROM pic p LEFT JOIN cells x USING (vec_id) LEFT JOIN sums USING (vec_id, r, k, c) WHERE p.vec_id % 50 <> 7 GROUP BY p.vec_id
UNION ALL SELECT vec_id, NULL FROM pic WHERE vec_id % 50 = 7""",
)
def image_features(spark, sf_dir):
    """A plug-in over images: a tensor of declared shape."""
    folder, _ = A.picture_files(spark, sf_dir)
    rgb = I.decode_images(read_files(list_files(spark, folder)))
    features = H.image_features(rgb, quadrant_sums, (2, 2, 3))
    numbers = F.array_join(F.transform("features", lambda x: x.cast("bigint").cast("string")), ",")
    return features.select(A.vec_id_of(F.col("path")).alias("vec_id"), numbers.alias("features"))


@query(
    "images_to_rgb",
    f"""WITH {sql.PIXELS}
SELECT vec_id, any_value(height) AS height, any_value(width) AS width,
       string_agg(lpad(upper(to_hex(v)), 2, '0'), '' ORDER BY i, c) AS pixels
FROM px JOIN img USING (vec_id) GROUP BY vec_id""",
)
def images_to_rgb(spark, sf_dir):
    folder, _ = A.image_files(spark, sf_dir)
    rgb = I.images_to_rgb(scan_images(spark, folder))
    return rgb.select(A.vec_id_of(F.col("path")).alias("vec_id"), "height", "width", F.hex("data").alias("pixels"))


@query(
    "images_resize",
    f"""WITH {sql.PIXELS}, planned AS (
  SELECT vec_id, {sql.planned_side('height')} AS h, {sql.planned_side('width')} AS w FROM img
)
SELECT vec_id, vec_id || '_resized.png' AS name, h::INTEGER AS height, w::INTEGER AS width,
       (h * w * 3)::INTEGER AS n_bytes FROM planned""",
)
def images_resize(spark, sf_dir):
    """Names, sizes and byte counts; the pixels themselves are tested against brute force."""
    folder, _ = A.image_files(spark, sf_dir)
    resized = I.images_resize(I.images_to_rgb(scan_images(spark, folder)))
    return resized.select(
        A.vec_id_of(F.col("path")).alias("vec_id"),
        F.element_at(F.split("derived_path", "/"), -1).alias("name"),
        "height",
        "width",
        F.octet_length("data").alias("n_bytes"),
    )

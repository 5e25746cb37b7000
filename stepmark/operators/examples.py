"""Row shape: identity, one image per row, the converted table and its split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 100_000


def example_key(df: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add `row_hash` and `ordinal`, which together identify a row even among equal rows.

    Rows are grouped by two hashes of their JSON form, not by their nested columns; one of equal
    rows is kept with their number (partial counts per task), so a row that makes up a third of
    the table reaches the shuffle as a few counts, not as its copies. The copies are put back
    from the count: up to `rows_per_block` in place, more in blocks spread over all tasks.
    """
    columns = df.columns
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rows = df.select(F.md5(text).alias("row_hash"), F.xxhash64(text).alias("_other"), F.struct(*columns).alias("_row"))
    hashed = rows.groupBy("row_hash", "_other").agg(F.count("*").alias("_copies"), F.any_value("_row").alias("_row"))
    few = hashed.where(F.col("_copies") <= rows_per_block).withColumn("_first", F.lit(0).cast("bigint"))
    many = (
        hashed.where(F.col("_copies") > rows_per_block)
        .withColumn(
            "_first",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(rows_per_block).cast("bigint"))),
        )
        .repartition("row_hash", "_first")
    )
    last = F.least(F.col("_first") + rows_per_block, F.col("_copies")) - 1
    return (
        few.unionByName(many)
        .withColumn("ordinal", F.explode(F.sequence(F.col("_first"), last)))
        .select("row_hash", "ordinal", "_row.*")
    )


def explode_images(df: DataFrame) -> DataFrame:
    """One row per image, messages repeated; an example without images gives no row."""
    others = [c for c in df.columns if c != "images"]
    return df.select(*others, F.explode("images").alias("image"))


def last_image(df: DataFrame) -> DataFrame:
    """Keep the last image of each example; NULL where there is none, which callers reject."""
    return df.withColumn("image", F.try_element_at("images", F.lit(-1))).drop("images")


def first_image(df: DataFrame) -> DataFrame:
    return df.withColumn("image", F.get("images", F.lit(0))).drop("images")


def wrap_image(df: DataFrame) -> DataFrame:
    """The single image of an example as a list of one."""
    return df.withColumn("images", F.array("image")).drop("image")


def project_example(df: DataFrame) -> DataFrame:
    return df.select("image", "messages")


def tag_split(df: DataFrame, split: str = "train") -> DataFrame:
    return df.withColumn("split", F.lit(split))


def count_examples(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("num_rows"))


def peek_n(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first `n` rows by key: a top-n, not a sort of the table."""
    return df.orderBy(key).limit(n)

"""A join that stays balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def salted_left_join(
    facts: DataFrame,
    unique: DataFrame,
    key: str,
    spread_by: list[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`facts` left join `unique` (at most one row per key), with hot keys split over tasks.

    Keys are counted first (partial counts per task, one column read). A key with more than
    `rows_per_task` rows is split into parts by a hash of `spread_by`, and its single row on
    the other side is repeated once per part. NULL keys match nothing and are spread as well.
    Every such key is on the list of hot keys, which has at most one row per `rows_per_task` rows;
    Spark broadcasts it if its measured size is within the session's bound and shuffles it otherwise.
    """
    hot = (
        facts.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
        .select(key, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_parts"))
    )
    spread = F.xxhash64(*spread_by)
    salted = facts.join(hot, key, "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(4096)))
        .when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts")))
        .otherwise(F.lit(0))
        .cast("int"),
    )
    repeated = unique.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return salted.drop("_parts").join(repeated.drop("_parts"), [key, "_salt"], "left").drop("_salt")

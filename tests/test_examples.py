import pytest
from examples import FIVE, frame
from pyspark.sql import functions as F

from stepmark.functions.refs import classify_image_ref
from stepmark.operators import examples as X
from stepmark.operators.joins import salted_left_join
from stepmark.operators.numbering import number_by_blocks
from stepmark.operators.rejects import reference_reason, reject_table, rejects


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_example_key_tells_equal_rows_apart(spark, block):
    rows = [("a", None)] * 50 + [("b", ["x"])] + [("a", ["x"])] * 3
    keyed = X.example_key(spark.createDataFrame(rows, "s string, l array<string>"), rows_per_block=block)
    got = [(r["row_hash"], r["ordinal"], r["s"], tuple(r["l"]) if r["l"] else None) for r in keyed.collect()]
    assert len(got) == 54 and len({g[:2] for g in got}) == 54
    assert sorted(g[1] for g in got if g[2:] == ("a", None)) == list(range(50))
    assert len({g[0] for g in got}) == 3


def test_example_key_does_not_depend_on_partitions(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("n"))
    first = {tuple(r) for r in X.example_key(df.repartition(3)).collect()}
    second = {tuple(r) for r in X.example_key(df.coalesce(1), rows_per_block=4).collect()}
    assert first == second and len(first) == 100


def images(spark):
    return frame(spark, [(1, ["p", "q"], FIVE), (2, [], FIVE), (3, None, FIVE), (4, ["p"], FIVE)])


def test_one_image_per_row(spark):
    df = images(spark)
    exploded = X.project_example(X.explode_images(df))
    assert exploded.columns == ["image", "messages"]
    assert sorted(r["image"] for r in exploded.collect()) == ["p", "p", "q"]
    assert {r["id"]: r["image"] for r in X.last_image(df).collect()} == {1: "q", 2: None, 3: None, 4: "p"}
    assert {r["id"]: r["image"] for r in X.first_image(df).collect()} == {1: "p", 2: None, 3: None, 4: "p"}
    assert {r["id"]: r["images"] for r in X.wrap_image(X.last_image(df)).collect()}[1] == ["q"]


def test_count_and_peek(spark):
    df = X.tag_split(images(spark))
    assert [tuple(r) for r in X.count_examples(df).collect()] == [("train", 4)]
    assert [r["id"] for r in X.peek_n(df.repartition(4), "id").collect()] == [1, 2, 3]


def test_reject_table(spark):
    refs = spark.createDataFrame([(1, "http://a"), (2, "/p"), (3, "data:image,x"), (4, None)], "id int, r string")
    ref = F.col("r")
    part = rejects(refs, F.col("id"), "reference", reference_reason(ref, classify_image_ref(ref)))
    got = {r["example_key"]: (r["stage"], r["reason"]) for r in reject_table(part, part.where("false")).collect()}
    assert got == {
        "1": ("reference", "remote reference: http://a"),
        "3": ("reference", "unrecognized reference: data:image,x"),
        "4": ("reference", "no reference"),
    }
    with pytest.raises(ValueError, match="rejected"):
        reject_table(part, strict=True)
    assert reject_table(part.where("false"), strict=True).count() == 0


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    unique = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), ("unused", 4)], "k string, v int")
    salted = salted_left_join(facts, unique, "k", ["id"], rows_per_task=100)
    plain = facts.join(unique, "k", "left")
    rows = lambda df: sorted((r["id"], r["k"] or "", r["v"] or 0) for r in df.collect())
    assert rows(salted) == rows(plain) and salted.count() == 3000


def test_salted_join_splits_the_hot_key(spark):
    facts = spark.range(2000).select("id", F.lit("hot").alias("k"))
    unique = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_left_join(facts, unique, "k", ["id"], rows_per_task=50)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 2000 and max(per_task) < 800


@pytest.mark.parametrize("few", [True, False])
def test_numbering_equals_row_number(spark, few):
    df = spark.range(500).select(
        (F.col("id") % 2).alias("g"), (F.hash("id") % 1000).alias("x"), "id"
    ).withColumn("b", F.floor(F.col("x") / 50))
    rows = number_by_blocks(df, ["g"], "b", ["x", "id"], "n", few_blocks=few).collect()
    for g in (0, 1):
        part = sorted((r for r in rows if r["g"] == g), key=lambda r: (r["x"], r["id"]))
        assert [r["n"] for r in part] == list(range(len(part)))

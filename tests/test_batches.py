import hashlib

import pytest
from pyspark.sql import functions as F

from stepmark.operators import batches as B


def order(ids, seed=42, epoch=0):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}-{seed}-{epoch}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.range(700).withColumnRenamed("id", "doc")


@pytest.mark.parametrize("partitions", [1, 5])
def test_shuffle_does_not_depend_on_partitions(docs, partitions):
    got = [r["doc"] for r in B.seeded_shuffle(docs.repartition(partitions), "doc").collect()]
    assert got == order(range(700))
    other = [r["doc"] for r in B.seeded_shuffle(docs.repartition(partitions), "doc", epoch=1).collect()]
    assert other == order(range(700), epoch=1) != got


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_global_index_is_the_shuffle_order(docs, digits):
    rows = B.global_index(docs, "doc", digits=digits).collect()
    assert [r["doc"] for r in sorted(rows, key=lambda r: r["idx"])] == order(range(700))
    assert sorted(r["idx"] for r in rows) == list(range(700))


def test_epochs_have_their_own_order(docs):
    rows = B.global_index(B.repeat_epochs(docs, 2), "doc", epoch="epoch").collect()
    for epoch in (0, 1):
        part = sorted((r for r in rows if r["epoch"] == epoch), key=lambda r: r["idx"])
        assert [r["doc"] for r in part] == order(range(700), epoch=epoch)


def test_each_place_of_a_step_is_taken_once(docs):
    plan = B.BatchPlan(micro_batch=2, accumulation=3, devices=4)
    rows = B.assign_batch(B.global_index(docs, "doc"), plan).collect()
    places = {(r["step"], r["slot"], r["device"], r["position"]) for r in rows}
    assert len(places) == 700
    assert all(r["slot"] < 3 and r["device"] < 4 and r["position"] < 2 for r in rows)
    full = [r for r in rows if r["step"] == 0]
    assert len(full) == plan.global_batch == 24
    assert all(len({r["position"] for r in rows if r["micro_batch"] == m}) == 2 for m in range(3))


def test_limit_steps(docs):
    batches = B.assign_batch(B.global_index(docs, "doc"), B.BatchPlan(2, 3, 4))
    assert B.limit_steps(batches, 2).count() == 48
    assert B.limit_steps(batches, -1).count() == 700


def test_group_by_length(docs):
    df = B.global_index(docs.withColumn("n", F.pmod(F.hash("doc"), F.lit(97))), "doc")
    rows = sorted(B.group_by_length(df, "n", "doc", 64).collect(), key=lambda r: r["idx"])
    assert [r["idx"] for r in rows] == list(range(700))
    before = order(range(700))
    for start in range(0, 700, 64):
        block = rows[start : start + 64]
        assert {r["doc"] for r in block} == set(before[start : start + 64])
        assert [r["n"] for r in block] == sorted((r["n"] for r in block), reverse=True)


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(i, [i] * (i % 4 + 1), [-100] * (i % 4) + [i]) for i in range(10)]
    return spark.createDataFrame(rows, "idx bigint, ids array<int>, labels array<int>")


@pytest.mark.parametrize("side", ["right", "left"])
def test_pad_and_collate(encoded, side):
    plan = B.BatchPlan(micro_batch=4, accumulation=1, devices=1)
    padded = B.pad_to_longest(B.assign_batch(encoded, plan), 99, labels="labels", side=side)
    rows = {r["micro_batch"]: r for r in B.batch_collate(padded).collect()}
    assert sorted(rows) == [0, 1, 2]
    last = rows[2]
    assert len(last["input_ids"]) == 2
    assert last["input_ids"][0] == ([8, 99] if side == "right" else [99, 8])
    assert last["labels"][0] == ([8, -100] if side == "right" else [-100, 8])
    for row in rows.values():
        assert len({len(x) for x in row["input_ids"] + row["labels"]}) == 1
    assert [ids[0 if side == "right" else -1] for ids in rows[1]["input_ids"]] == [4, 5, 6, 7]


def test_padding_is_never_supervised(encoded):
    from stepmark.functions.labels import mask_keep, pad_conflict_count

    padded = B.pad_to_longest(B.assign_batch(encoded, B.BatchPlan(5, 1, 1)), 99)
    labelled = padded.withColumn("labels", mask_keep(F.col("ids"), [3, 7]))
    conflicts = labelled.select(F.sum(pad_conflict_count(F.col("ids"), F.col("labels"), 99))).first()[0]
    assert conflicts == 0


def test_split_and_mix_are_stable(docs):
    split = {r["doc"]: r["split"] for r in B.split_train_test(docs, "doc", 0.2, seed=7).collect()}
    again = {r["doc"]: r["split"] for r in B.split_train_test(docs.repartition(3), "doc", 0.2, seed=7).collect()}
    assert split == again and 90 < list(split.values()).count("test") < 190
    expected = {i for i in range(700) if int(hashlib.md5(f"{i}-7".encode()).hexdigest()[:8], 16) < 0.2 * 2**32}
    assert {d for d, s in split.items() if s == "test"} == expected
    mixed = B.dataset_mix({"all": (docs, "doc", 1.0), "some": (docs, "doc", 0.3), "none": (docs, "doc", 0.0)})
    counts = {r["dataset"]: r["count"] for r in mixed.groupBy("dataset").count().collect()}
    assert counts["all"] == 700 and 150 < counts["some"] < 270 and "none" not in counts


def test_keys_and_images_in_batches(spark):
    """In position order, whatever order the rows come in; equal ids do not decide the order."""
    rows = [(i, f"k{i}", [7], [7], [f"{i}.png", "s.png"] if i % 3 else ([] if i else None)) for i in range(10)]
    df = spark.createDataFrame(rows, "idx bigint, key string, ids array<int>, labels array<int>, images array<string>").orderBy(F.desc("idx"))
    plan = B.BatchPlan(micro_batch=4, accumulation=1, devices=1)
    padded = B.pad_to_longest(B.assign_batch(df, plan), 99)
    got = {r["micro_batch"]: r for r in B.batch_collate(padded, key="key", images="images").collect()}
    assert got[0].asDict().keys() == {"micro_batch", "keys", "input_ids", "labels", "images"}
    for batch in range(3):
        here = rows[4 * batch : 4 * batch + 4]
        assert got[batch]["keys"] == [r[1] for r in here]
        assert got[batch]["images"] == [r[4] or [] for r in here]
    assert B.batch_collate(padded).columns == ["micro_batch", "input_ids", "labels"]
    assert B.batch_collate(padded, key="key").columns == ["micro_batch", "keys", "input_ids", "labels"]


def test_special_tokens_are_checked_in_the_flows(spark):
    from examples import FIVE, frame

    from stepmark.operators.tokens import token_ids
    from stepmark.plans import flows

    df = frame(spark, [(1, ["a.png"], FIVE), (2, [], FIVE)])
    from stepmark.operators.tokens import full_vocab

    vocab = full_vocab(flows.rendered_text(df))
    marks = token_ids(vocab, ["<+>", "<->"])
    keep = list(marks.values())
    (batch,) = flows.training_batches(df, vocab, "id", keep, 999, images="images", expected=marks).collect()
    assert sorted(zip(batch["keys"], batch["images"], strict=True)) == [(1, ["a.png"]), (2, [])]
    assert all(len([x for x in row if x != -100]) == 2 for row in batch["labels"])
    for flow in (flows.training_batches, flows.indexed_batches):
        with pytest.raises(ValueError, match="special tokens"):
            flow(df, vocab, "id", keep, 999, expected={"<+>": 12345})
        with pytest.raises(ValueError, match="special tokens"):
            flow(df, vocab, "id", [], marks["<+>"], expected=marks)
    with pytest.raises(ValueError, match="padding id"):
        flows.training_batches(df, vocab, "id", keep, keep[0])


def test_number_by_ranges(spark):
    from stepmark.operators.numbering import number_by_ranges

    df = spark.range(5000).selectExpr("id", "id % 7 AS n").repartition(13)
    got = number_by_ranges(df, [F.desc("n"), F.asc("id")], "place").collect()
    expected = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert [r["id"] for r in sorted(got, key=lambda r: r["place"])] == expected
    assert sorted(r["place"] for r in got) == list(range(5000))
    assert number_by_ranges(df.limit(0), [F.asc("id")], "place").count() == 0


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("micro_batch", [1, 2, 7])
def test_batches_collated_in_their_blocks(spark, digits, micro_batch):
    """Whatever the blocks, the batches are those of the operators one by one."""
    from stepmark.functions.labels import mask_keep

    rows = [(i, [i % 5] * (i % 9 + 1), [f"{i}.png"] if i % 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "key bigint, ids array<int>, images array<string>").repartition(5)
    plan = B.BatchPlan(micro_batch=micro_batch, accumulation=2, devices=2)
    label = lambda ids: mask_keep(ids, [1, 2])
    one_by_one = B.pad_to_longest(B.assign_batch(B.global_index(df, "key"), plan), 99).withColumn("labels", label(F.col("ids")))
    expected = B.batch_collate(one_by_one, key="key", images="images")
    got = B.collated_batches(df, "key", 99, label, plan, "images", digits=digits)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert B.collated_batches(df.limit(0), "key", 99, label, plan).count() == 0


def test_ids_are_exchanged_once(spark):
    """One exchange by block, read by both halves, and one behind the filter of border batches."""
    from stepmark.functions.labels import mask_keep

    df = spark.range(20_000).selectExpr("id AS key", "array(1, 2, int(id % 7)) AS ids")
    batches = B.collated_batches(df, "key", 99, lambda ids: mask_keep(ids, [1]), B.BatchPlan(2, 1, 1), digits=1)
    batches.collect()
    plan = batches._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    of_ids = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    by_block = [line for line in of_ids if "hashpartitioning(_block" in line]
    by_batch = [line for line in of_ids if "hashpartitioning(micro_batch" in line]
    assert by_batch and len(by_batch) == 1 and not any("_block" in line and "micro_batch" in line for line in of_ids)
    assert len(by_block) == 2, "the ids, and the counts of the blocks"
    assert any("ReusedExchange" in line and "ids" in line for line in plan.splitlines())
    border = B.collated_batches(df, "key", 99, lambda ids: mask_keep(ids, [1]), B.BatchPlan(2, 1, 1), digits=1)
    assert border.count() == 10_000

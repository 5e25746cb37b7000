import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepmark.functions import labels as L
from stepmark.functions import numbers as N
from stepmark.functions import refs as R
from stepmark.functions import sizes as S
from stepmark.functions.text import tokenize_text, trim_text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def values(spark, schema, rows, column):
    return [r["x"] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column.alias("x")).collect()]


def test_rounding_to_multiples(spark):
    rows = [(0,), (14,), (42,), (70,), (27,), (29,), (56,)]
    x = F.col("n")
    assert values(spark, "n bigint", rows, N.round_by_factor(x, 28)) == [0, 0, 56, 56, 28, 28, 56]
    assert values(spark, "n bigint", rows, N.ceil_by_factor(x, 28)) == [0, 28, 56, 84, 28, 56, 56]
    assert values(spark, "n bigint", rows, N.floor_by_factor(x, 28)) == [0, 0, 28, 56, 0, 28, 56]


def test_cosine(spark):
    rows = [([1.0, 0.0], [0.0, 2.0]), ([1.0, 2.0], [2.0, 4.0]), ([1.0, 1.0], [-1.0, -1.0]), ([0.0, 0.0], [1.0, 1.0])]
    got = values(spark, "a array<float>, b array<float>", rows, N.cosine_similarity(F.col("a"), F.col("b")))
    assert got[:3] == pytest.approx([0.0, 1.0, -1.0])
    assert got[3] is None


def test_aspect_limit(spark):
    rows = [(1, 200), (1, 201), (400, 2), (402, 2), (0, 5), (5, -1)]
    got = values(spark, "h int, w int", rows, S.aspect_ratio_reject(F.col("h"), F.col("w")))
    assert got == [False, True, False, True, True, True]


def test_resize_plan_by_hand(spark):
    rows = [
        (56, 56),  # on both multiples, area at the lower bound
        (8, 8),  # too small: scaled by 7, then up
        (1000, 500),  # rounds to 1008 x 504
        (1, 200),  # the longest aspect that passes
        (1, 90),  # too small: scaled by 5.9, then up
        (1, 201),  # rejected
        (5000, 4000),  # too large: floored
    ]
    plan = S.resize_plan(F.col("h"), F.col("w"))
    got = values(spark, "h int, w int", rows, plan)
    assert [tuple(p) if p else None for p in got] == [
        (56, 56), (56, 56), (1008, 504), (28, 196), (28, 532), None, (4004, 3192),
    ]


sides = st.integers(min_value=1, max_value=6000)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(sides, sides), min_size=40, max_size=40))
def test_resize_plan_properties(spark, pairs):
    df = spark.createDataFrame(pairs, "h int, w int")
    low, high = S.TRAINING.min_pixels, S.TRAINING.max_pixels
    plan = S.resize_plan(F.col("h"), F.col("w"), F.lit(low), F.lit(high))
    for h, w, p in df.select("h", "w", plan.alias("p")).collect():
        if max(h, w) / min(h, w) > 200:
            assert p is None
            continue
        assert p["height"] % 28 == 0 and p["width"] % 28 == 0
        assert p["height"] >= 28 and p["width"] >= 28
        grown = math.ceil(h * math.sqrt(low / (h * w)) / 28)
        if p["height"] * p["width"] > high:
            assert 28 in (p["height"], p["width"]) or p["height"] == grown * 28


def test_pixel_budget_and_requested_size(spark):
    rows = [
        (100, 100, None, None, None, None),
        (100, 100, 60, None, None, 40000),  # only one requested side: own sides, own bound
        (100, 100, 280, 560, None, 1),  # both requested: the bound of the row is ignored
    ]
    schema = "h int, w int, rh int, rw int, lo bigint, hi bigint"
    chosen = S.requested_size(*[F.col(c) for c in ("h", "w", "rh", "rw", "lo", "hi")])
    got = [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(
        *[c.alias(n) for n, c in chosen.items()]).collect()]
    default = (S.CONVERSION_MIN_PIXELS, S.CONVERSION_MAX_PIXELS)
    assert got == [(100, 100, *default), (100, 100, default[0], 40000), (280, 560, *default)]


def test_references(spark):
    rows = [
        ("http://a/b.png",), ("https://a/b.png",), ("file:///a/b.png",), ("data:image/png;base64,aGk=",),
        ("data:image/svg,x",), ("/a/b.png",), (None,),
    ]
    ref = F.col("r")
    kinds = values(spark, "r string", rows, R.classify_image_ref(ref))
    assert kinds == ["http", "http", "file", "data", "unrecognized", "path", None]
    assert values(spark, "r string", rows[2:3], R.strip_file_scheme(ref)) == ["/a/b.png"]
    assert bytes(values(spark, "r string", rows[3:4], R.decode_data_uri(ref))[0]) == b"hi"
    assert values(spark, "r string", rows[5:6], R.decode_data_uri(ref)) == [None]


def test_rewrite_prefix_everywhere(spark):
    got = one(spark, R.rewrite_prefix(F.array(F.lit("s3://x/a/s3://x/b"), F.lit("/other")), "s3://x/", "/base"))
    assert got == ["/base/a//base/b", "/other"]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/a/b.png", "/a/b_resized.png"),
        ("/a.b/c", "/a.b/c_resized"),
        ("/a/.hidden", "/a/.hidden_resized"),
        ("/a/..x.png", "/a/..x_resized.png"),
        ("b.tar.gz", "b.tar_resized.gz"),
        ("/a/b.", "/a/b_resized."),
        ("b", "b_resized"),
    ],
)
def test_derived_path(spark, path, expected):
    assert one(spark, R.derive_resized_path(F.lit(path))) == expected


def test_trim_every_white_space(spark):
    assert one(spark, trim_text(F.lit("　\t\x0b a b  \n\x1c"))) == "a b"


def test_tokens_keep_marks_whole(spark):
    got = one(spark, tokenize_text(F.lit("ab_1 <+>é<->\n<image>< +>x")))
    assert got == ["ab_1", "<+>", "é", "<->", "<image>", "<", "+", ">", "x"]


def test_masks_and_counts(spark):
    ids, labels = F.col("ids"), F.col("labels")
    row = spark.createDataFrame([([5, 1, 2, 5, 9, 9],)], "ids array<int>")
    kept = row.withColumn("labels", L.mask_keep(ids, [1, 2]))
    assert kept.first()["labels"] == [-100, 1, 2, -100, -100, -100]
    assert kept.select(L.supervised_count(labels), L.label_count(labels, 1), L.pad_conflict_count(ids, labels, 9)).first()[:] == (2, 1, 0)
    dropped = row.withColumn("labels", L.mask_drop(ids, [9]))
    assert dropped.first()["labels"] == [5, 1, 2, 5, -100, -100]
    assert dropped.select(L.pad_conflict_count(ids, labels, 5)).first()[0] == 2
    assert row.select(L.truncate_right(ids, 2)).first()[0] == [5, 1]

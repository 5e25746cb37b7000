import pytest
from examples import FIVE, frame
from pyspark.sql import functions as F

from stepmark.functions import labels as L
from stepmark.operators import reports as R
from stepmark.operators import tokens as T
from stepmark.plans.flows import rendered_text

WORDS = ["a", "b", "<+>", "<->", ","]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(w, i) for i, w in enumerate(WORDS)], "token string, token_id int")


@pytest.fixture(scope="module")
def tokens(spark):
    rows = [(1, ["b", "a", "zz", "b"]), (2, []), (3, None), (4, ["<+>"]), (5, ["zz"])]
    return spark.createDataFrame(rows, "id bigint, tokens array<string>")


def by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


EXPECTED = {1: [1, 0, -1, 1], 2: [], 3: None, 4: [2], 5: [-1]}


def test_build_vocab_counts_then_token(spark, tokens):
    got = {r["token"]: r["token_id"] for r in T.build_vocab(tokens, 3).collect()}
    assert got == {"b": 0, "zz": 1, "<+>": 2}


def test_lookup_in_place(vocab, tokens):
    assert by_id(T.vocab_lookup(tokens, vocab, "id"), "ids") == EXPECTED


@pytest.mark.parametrize("bound", ["MAX_BROADCAST_TOKENS", "MAX_BROADCAST_BYTES"])
def test_lookup_of_a_vocabulary_beyond_the_bounds(vocab, tokens, monkeypatch, bound):
    monkeypatch.setattr(T, bound, 3)
    assert by_id(T.vocab_lookup(tokens, vocab, "id"), "ids") == EXPECTED


def test_lookup_by_join_with_hot_tokens(spark, vocab):
    rows = [(i, ["b"] * 50 + [WORDS[i % 5], "zz"]) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    joined = T.lookup_by_join(df, vocab, "id", "tokens", "token", "ids", "token_id", F.lit(-1), rows_per_task=100)
    assert by_id(joined, "ids") == {i: [1] * 50 + [i % 5, -1] for i in range(40)}


def test_lists_of_a_joined_lookup_are_not_shuffled(spark, vocab):
    rows = [(i, None if i % 9 == 4 else ["b"] * (i % 5) + [WORDS[i % 5], "zz", None]) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>").coalesce(3)
    joined = T.lookup_by_join(df, vocab, "id", "tokens", "token", "ids", "token_id", F.lit(-1), rows_per_task=7)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    known = {w: i for i, w in enumerate(WORDS)}
    assert by_id(joined, "ids") == {i: t if t is None else [known.get(w, -1) for w in t] for i, t in rows}


def test_lookups_that_share_blocks_write_the_rows_once(spark, vocab, monkeypatch):
    monkeypatch.setattr(T, "MAX_BROADCAST_TOKENS", 3)
    written = []
    through_table = T.through_table
    monkeypatch.setattr(T, "through_table", lambda df, name, **how: written.append(name) or through_table(df, name, **how))
    rows = [(i, None if i % 9 == 4 else ["b"] * (i % 5) + [WORDS[i % 5], "zz", None]) for i in range(40)] + [(99, [])]
    df = T.in_blocks(spark.createDataFrame(rows, "id bigint, tokens array<string>").coalesce(3), "block", 7)
    # The blocks hold wherever their rows lie later.
    encoded = T.vocab_lookup(df.repartition(5, "id"), vocab, "id", block="block").drop("tokens")
    decoded = R.decoded_text(encoded, vocab, "id", block="block")
    assert written == ["blocks"]
    known = {w: i for i, w in enumerate(WORDS)}
    assert by_id(decoded, "ids") == {i: t if t is None else [known.get(w, -1) for w in t] for i, t in rows}
    words = {i: t if t is None else " ".join(w if w in known else "<UNKNOWN:-1>" for w in t) for i, t in rows}
    assert by_id(decoded, "decoded_text") == words


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_reverse_lookup(spark, vocab, monkeypatch, limit):
    monkeypatch.setattr(T, "MAX_BROADCAST_TOKENS", limit)
    df = spark.createDataFrame([(1, [4, 77, 0]), (2, []), (3, [77])], "id bigint, ids array<int>")
    got = by_id(T.vocab_reverse_lookup(df, vocab, "id"), "tokens")
    assert got == {1: [",", "<UNKNOWN:77>", "a"], 2: [], 3: ["<UNKNOWN:77>"]}


def test_special_tokens(spark, vocab):
    existing = vocab.select("token", F.col("token_id").cast("bigint").alias("position"))
    new = spark.createDataFrame([("<+>", 0), ("<x>", 1), ("<w>", 2), ("<x>", 3)], "token string, position bigint")
    union = {r["token"]: (r["is_new"], r["position"]) for r in T.special_token_union(existing, new).collect()}
    assert len(union) == 7 and union["<+>"] == (0, 2) and union["<x>"] == (1, 1)
    extended = {r["token"]: r["token_id"] for r in T.extend_vocab(vocab, new).collect()}
    assert extended == {**{w: i for i, w in enumerate(WORDS)}, "<x>": 5, "<w>": 6}
    empty = vocab.where("false")
    assert {r["token"]: r["token_id"] for r in T.extend_vocab(empty, new).collect()} == {"<+>": 0, "<x>": 1, "<w>": 2}


def test_check_token_ids(vocab):
    assert T.check_token_ids(vocab, {"<+>": 2, "<->": 3}, pad_id=4, strict=True).count() == 0
    problems = {r["token"]: r["problem"] for r in T.check_token_ids(vocab, {"<+>": 2, "<->": 9, "?": 1}, pad_id=2).collect()}
    assert problems == {"<+>": "same id as padding", "<->": "unexpected id", "?": "unknown token"}
    with pytest.raises(ValueError, match="unexpected id"):
        T.check_token_ids(vocab, {"<->": 9}, pad_id=0, strict=True)


def test_plugin_tokenizer(spark):
    encode = T.tokenizer_plugin(lambda: lambda texts: [[len(word) for word in t.split()] for t in texts])
    df = spark.createDataFrame([("a bb",), ("",)], "text string").coalesce(1)
    assert [r[0] for r in df.select(encode("text")).collect()] == [[1, 2], []]


def test_plugin_tokenizer_gets_few_texts_at_once(spark):
    encode = T.tokenizer_plugin(lambda: lambda texts: [[len(t or "")] + sorted(len(s or "") for s in texts) for t in texts])
    sizes = [600_000, 0, 700_000, 3_000_000, 500_000, 400_000]
    df = spark.range(7, numPartitions=1).select("id", F.expr(f"repeat('x', array({', '.join(map(str, sizes))}, null)[int(id)])").alias("text"))
    got = by_id(df.select("id", encode("text").alias("ids")), "ids")
    assert [got[i][0] for i in range(7)] == [*sizes, 0]
    assert max(sum(ids[1:-1]) for ids in got.values()) <= T.PLUGIN_CHARACTERS  # without the longest text of a call


@pytest.fixture(scope="module")
def labelled(spark, vocab):
    df = T.vocab_lookup(rendered_text(frame(spark, [(1, [], FIVE)])), vocab, "id").select("id", "ids")
    return df.withColumn("labels", L.mask_keep(F.col("ids"), [2, 3]))


def test_five_messages_supervise_two_positions(labelled):
    row = R.good_bad_count(R.with_supervised_count(labelled), 2, 3).first()
    assert (row["n_supervised"], row["n_good"], row["n_bad"]) == (2, 1, 1)
    assert len(row["ids"]) == len(row["labels"])
    assert R.no_supervision_examples(labelled).count() == 0


def test_supervised_text(labelled, vocab):
    row = R.supervised_text(labelled, vocab, "id").first()
    assert (row["supervised_ids"], row["supervised_text"]) == ([2, 3], "<+> <->")


def test_status_order(spark, vocab):
    rows = [(1, [2, 3, 0, 2, 9], [2, 3, 0, -100, 9])]
    df = spark.createDataFrame(rows, "id bigint, ids array<int>, labels array<int>")
    got = [(r["pos"], r["token"], r["status"]) for r in R.token_status(df, vocab, "id", 2, 3).orderBy("pos").collect()]
    assert got == [
        (0, "<+>", "GOOD_TOKEN"), (1, "<->", "BAD_TOKEN"), (2, "a", "UNMASKED"), (3, "<+>", "MASKED"),
        (4, "<UNKNOWN:9>", "UNMASKED"),
    ]
    assert R.decoded_text(df, vocab, "id").first()["decoded_text"] == "<+> <-> a <+> <UNKNOWN:9>"


def test_token_accuracy(spark):
    rows = [([1, 2, 3], [-100, 2, 9]), ([1, 1, 1], [1, 1, -100])]
    df = spark.createDataFrame(rows, "predicted array<int>, labels array<int>")
    assert R.token_accuracy(df).first()[:] == (3, 4, 0.75)
    nothing = spark.createDataFrame([([1], [-100])], "predicted array<int>, labels array<int>")
    assert R.token_accuracy(nothing).first()["token_accuracy"] is None


@pytest.mark.parametrize("bound", [10, 0])
def test_both_lookups_agree_on_awkward_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(T, "MAX_BROADCAST_TOKENS", bound)
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("a", 7), (None, 3)], "token string, token_id int")
    rows = [(None, ["a"]), (1, ["a", "x", "b"]), (1, ["b"]), (1, ["b"]), (2, []), (3, None), (None, ["a", None])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = [r["ids"] for r in T.vocab_lookup(df, vocab, "id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [[0], [0, -1, 1], [1], [1], [], None, [0, -1]]))


def test_a_missing_token_raises(vocab):
    with pytest.raises(KeyError):
        T.token_ids(vocab, ["<+>", "nowhere"])

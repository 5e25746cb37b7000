"""Vocabulary tables and token ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmark.operators.numbering import number_by_ranges
from stepmark.session import shared_path, through_table
from stepmark.sources.files import open_storage

UNKNOWN_ID = -1

# A vocabulary up to this size is sent to every executor; a larger one is joined by shuffle.
MAX_BROADCAST_TOKENS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def token_counts(tokens: DataFrame) -> DataFrame:
    """(token, n) of the array column `tokens`; counting combines per task before the shuffle."""
    # Outer, with the empty rows filtered after: a plain explode adds a filter on the size of the
    # array, and with it computes the tokens a second time.
    exploded = tokens.select(F.explode_outer("tokens").alias("token")).where(F.col("token").isNotNull())
    return exploded.groupBy("token").agg(F.count("*").alias("n"))


def full_vocab(tokens: DataFrame) -> DataFrame:
    """All tokens of the array column `tokens`, most frequent first, ties by token; ids from 0.

    The ids are those of `build_vocab` without a limit, numbered by ranges and not in one task.
    """
    numbered = number_by_ranges(token_counts(tokens), [F.desc("n"), F.asc("token")], "token_id")
    return numbered.select("token", F.col("token_id").cast("int").alias("token_id"))


def build_vocab(tokens: DataFrame, size: int) -> DataFrame:
    """The `size` most frequent tokens of the array column `tokens`, ties by token; ids from 0.

    A top-n; numbering runs over the `size` rows of the result only.
    """
    top = token_counts(tokens).orderBy(F.desc("n"), "token").limit(size)
    token_id = F.row_number().over(W.orderBy(F.desc("n"), "token")) - 1
    return top.select("token", token_id.cast("int").alias("token_id"))


def special_token_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """(token, position) of both lists, existing ones first, each token once."""
    places = existing.select("token", "position", F.lit(0).alias("later")).unionByName(
        new.select("token", "position", F.lit(1).alias("later"))
    )
    return places.groupBy("token").agg(F.min(F.struct("later", "position")).alias("place")).select(
        "token", F.col("place.later").alias("is_new"), F.col("place.position").alias("position")
    )


def extend_vocab(vocab: DataFrame, new: DataFrame) -> DataFrame:
    """`vocab` plus the tokens of `new` (token, position) it lacks, with the next free ids.

    New tokens are numbered by position, then token; there may be any number of them.
    """
    added = new.groupBy("token").agg(F.min("position").alias("position")).join(vocab, "token", "left_anti")
    top_id = vocab.agg(F.coalesce(F.max("token_id"), F.lit(-1)).alias("top")).scalar()
    numbered = number_by_ranges(added, [F.asc("position"), F.asc("token")], "place").select(
        "token", (F.col("place") + top_id + 1).cast("int").alias("token_id")
    )
    return vocab.select("token", "token_id").unionByName(numbered)


def token_ids(vocab: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Ids of a few named tokens; a token that the vocabulary lacks raises."""
    found = vocab.where(F.col("token").isin(*tokens)).groupBy("token").agg(F.min("token_id").alias("token_id")).collect()
    ids = {row["token"]: row["token_id"] for row in found}
    if missing := sorted(set(tokens) - set(ids)):
        raise KeyError(f"not in the vocabulary: {missing}")
    return ids


def check_token_ids(vocab: DataFrame, expected: dict[str, int], pad_id: int, strict: bool = False) -> DataFrame:
    """Violations, one row each: a token that lacks its expected id, or shares the padding id."""
    wanted = vocab.sparkSession.createDataFrame(
        [(token, token_id) for token, token_id in expected.items()], "token string, expected_id int"
    )
    found = vocab.where(F.col("token").isin(*expected)).select("token", "token_id")
    problem = (
        F.when(F.col("token_id").isNull(), "unknown token")
        .when(F.col("token_id") != F.col("expected_id"), "unexpected id")
        .when(F.col("token_id") == pad_id, "same id as padding")
    )
    violations = (
        wanted.join(found, "token", "left")
        .withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
    )
    if strict:
        first = violations.take(1)
        if first:
            raise ValueError(f"special tokens: {first[0].asDict()}")
    return violations


def _unique(vocab: DataFrame, key: str, result: str) -> DataFrame:
    """One row per key: the smallest result. NULL keys name nothing."""
    return vocab.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(result).alias(result))


def _small_vocab(vocab: DataFrame) -> pa.Table | None:
    """The vocabulary itself if it is within the broadcast bounds, by count and by bytes."""
    size = vocab.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("bytes")
    ).first()
    if size["rows"] > MAX_BROADCAST_TOKENS or size["bytes"] > MAX_BROADCAST_BYTES:
        return None
    return vocab.select("token", "token_id").toArrow()


def _map_list(values: pa.ListArray, keys: pa.Array, results: pa.Array, unknown: pa.Array) -> pa.ListArray:
    """Look up every element of every list at once; `unknown` stands in where no key matches."""
    flat = values.flatten()
    found = results.take(pc.index_in(flat, value_set=keys.cast(flat.type)))
    found = pc.coalesce(found, unknown if len(unknown) == len(flat) else unknown[0])
    lengths = pc.fill_null(pc.list_value_length(values), 0)
    offsets = pa.array([0], pa.int32()) if len(values) == 0 else pa.concat_arrays(
        [pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())]
    )
    return pa.ListArray.from_arrays(offsets, found, mask=pc.is_null(values))


def in_blocks(df: DataFrame, block: str, rows_per_task: int = 100_000) -> DataFrame:
    """`df` written once, with the number of the block each row lies in as column `block`.

    A block is at most `rows_per_task` rows of one task. Several lookups in the rows may share it.
    """
    number = F.floor(F.monotonically_increasing_id() / rows_per_task)
    return through_table(df.withColumn(block, number), "blocks", compression="zstd")


def vocab_lookup(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    tokens: str = "tokens",
    ids: str = "ids",
    unknown_id: int = UNKNOWN_ID,
    block: str | None = None,
) -> DataFrame:
    """Add the array `ids` for the array `tokens`; a token not in `vocab` gets `unknown_id`.

    A vocabulary within the broadcast bounds goes to the tasks and every list is looked up where
    it lies, without a shuffle. A larger one is joined by blocks of rows, see `lookup_by_join`. A token that the
    vocabulary has several times has its smallest id; both ways give the same for any rows.
    """
    vocab = _unique(vocab, "token", "token_id")
    small = _small_vocab(vocab)
    if small is None:
        return lookup_by_join(df, vocab, key, tokens, "token", ids, "token_id", F.lit(unknown_id), block=block)
    words = small["token"].combine_chunks()
    numbers = small["token_id"].combine_chunks()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def to_ids(lists: pa.Array) -> pa.Array:
        return _map_list(lists, words, numbers, pa.array([unknown_id], pa.int32()))

    return df.withColumn(ids, to_ids(F.col(tokens)))


def vocab_reverse_lookup(
    df: DataFrame, vocab: DataFrame, key: str, ids: str = "ids", tokens: str = "tokens", block: str | None = None
) -> DataFrame:
    """Add the array `tokens` for the array `ids`; an id not in `vocab` reads `<UNKNOWN:id>`.

    An id of several tokens reads as the smallest of them.
    """
    vocab = _unique(vocab, "token_id", "token")
    small = _small_vocab(vocab)
    if small is None:
        unknown = F.concat(F.lit("<UNKNOWN:"), F.col("token_id").cast("string"), F.lit(">"))
        return lookup_by_join(df, vocab, key, ids, "token_id", tokens, "token", unknown, block=block)
    words = small["token"].combine_chunks()
    numbers = small["token_id"].combine_chunks()

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def to_tokens(lists: pa.Array) -> pa.Array:
        texts = lists.flatten().cast(pa.string())
        unknown = pc.binary_join_element_wise("<UNKNOWN:", texts, ">", "")
        return _map_list(lists, numbers, words, unknown)

    return df.withColumn(tokens, to_tokens(F.col(ids)))


def _distinct_elements(rows: DataFrame, block: str, values: str, name: str) -> DataFrame:
    """(block, element) of the lists of each block, NULL among them, once per task that reads of the block."""
    kind = rows.schema[values].dataType.elementType

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = None, None

        def rest() -> Iterator[pa.RecordBatch]:
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(held, pa.int64()), len(found)), found], ["block", name])

        for batch in batches:
            numbers, lists = batch.column(0).to_numpy(), batch.column(1)
            starts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist()] if len(numbers) else []
            for first, end in zip(starts, [*starts[1:], len(numbers)], strict=False):
                elements = lists.slice(first, end - first).flatten()
                if held != numbers[first]:
                    yield from rest()
                    held, found = int(numbers[first]), pa.nulls(1, elements.type)
                found = pc.unique(pa.concat_arrays([found, pc.unique(elements)]))
        yield from rest()

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField(name, kind)])
    return rows.select(block, values).mapInArrow(distinct, schema)


def lookup_by_join(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    values: str,
    vocab_key: str,
    results: str,
    vocab_result: str,
    unknown,
    rows_per_task: int = 100_000,
    block: str | None = None,
) -> DataFrame:
    """The lookup for a vocabulary of any size: the distinct elements of each block of rows, joined.

    Rows are written once with the block they lie in, at most `rows_per_task` rows of one task; rows
    that come from `in_blocks` name that column as `block` and are not written again. Only
    a block's distinct elements are joined with the vocabulary, and what is found is written to a
    folder of that block, which the tasks read beside its rows. So the lists go through no shuffle,
    a frequent token is one row per block, and a task holds the words of one block. Rows are
    told apart by where they lie, so equal and NULL keys are no matter.
    """
    rows, number = (in_blocks(df, "_words", rows_per_task), "_words") if block is None else (df, block)
    # Dealt out by element, told apart there, and joined where they are: one exchange.
    wanted = _distinct_elements(rows, number, values, vocab_key).repartition(vocab_key).distinct()
    found = wanted.join(vocab.select(vocab_key, vocab_result), vocab_key, "left").select(
        "block", F.col(vocab_key).alias("key"), F.coalesce(vocab_result, unknown).alias("result")
    )
    folder = shared_path(df.sparkSession, "words")
    found.repartition("block").write.partitionBy("block").parquet(folder, compression="zstd")
    held: dict[int, tuple[pa.Array, pa.Array]] = {}

    def words(number: int) -> tuple[pa.Array, pa.Array]:
        if number not in held:
            held.clear()
            storage, place = open_storage(folder)
            table = pq.read_table(f"{place}/block={number}", filesystem=storage, partitioning=None)
            held[number] = (table["key"].combine_chunks(), table["result"].combine_chunks())
        return held[number]

    @F.arrow_udf(T.ArrayType(found.schema["result"].dataType))
    def look_up(lists: pa.Array, blocks: pa.Array) -> pa.Array:
        numbers = blocks.to_numpy()
        starts = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist()
        parts = []
        for first, end in zip(starts, [*starts[1:], len(numbers)], strict=False):
            keys, known = words(int(numbers[first]))
            parts.append(_map_list(lists.slice(first, end - first), keys, known, pa.nulls(1, known.type)))
        return pa.concat_arrays(parts)

    looked_up = rows.withColumn(results, look_up(F.col(values), F.col(number)))
    return looked_up.drop("_words") if block is None else looked_up


#: Characters that a tokenizer gets at once, one longer text alone.
PLUGIN_CHARACTERS = 1 << 20


def tokenizer_plugin(factory: Callable[[], Callable[[list[str]], list[list[int]]]]):
    """A user's tokenizer as a column function, text to ids.

    `factory` builds the tokenizer once per Python worker; it is then called on texts of about
    `PLUGIN_CHARACTERS` characters together, so the ids of a few texts are in Python at a time,
    whatever a batch holds.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = factory()
        for texts in batches:
            characters = texts.str.len().fillna(0).cumsum() // PLUGIN_CHARACTERS
            for _, some in texts.groupby(characters.to_numpy(), sort=False):
                yield pd.Series(tokenizer(some.tolist()), index=some.index)

    return encode

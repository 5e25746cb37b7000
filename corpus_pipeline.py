"""A corpus pipeline over `documents`: each stage applies one operator to what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmark.llm import decontaminate, language, mixing, ngram_join, token_files
from stepmark.llm.common import held_out, through_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language as `lang`.

    NULL texts and texts without a letter go; the other columns stay, whatever their names. Equal
    rows get equal languages. An empty table gives none.
    """
    model = language.train(docs, ~held_out(F.col("doc_id"), 4, 2))
    found = language.with_guess(docs, model).where(F.col("__guess.lang_pred") != language.UNDETERMINED)
    return found.withColumn("lang", F.col("__guess.lang_pred")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word similarity of 0.8 or more, the one of
    smallest id; of rows that repeat it all stay. Texts without a word are linked with none."""
    return ngram_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; NULL and empty texts have none."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources take them; texts without words once."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, as read back: doc_id, start, n_tokens, ids_crc32. Repeated rows
    count each."""
    manifest = token_files.write_token_files(docs, token_files.token_folder(spark), token_files.default_tokenizer())
    return token_files.read_token_files(manifest)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]

#: Kernels, MinHash and the tokenizer are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = through_table(stage(spark, docs, sf_dir), name)
    return docs

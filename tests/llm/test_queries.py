"""The registered queries and the pipeline on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stepmark.llm import queries as llm

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in llm.queries()} == set(range(1, 14))
    assert {"pipeline", *llm.queries()} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "decontaminate", "source_mix", "token_files"]


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, name):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    df = llm.queries()[name](spark, SF_DIR)
    cursor = sql.execute(llm.oracle_sql()[name])
    places = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert sorted(tuple(r[p] for p in places) for r in cursor.fetchall()) == sorted(map(tuple, df.collect()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]

"""Every registered query on the smallest tables, against its SQL where it has one."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from stepmark.plans.catalog import CHECKS, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(rows):
    return sorted(tuple("NULL" if v is None else str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = canonical([tuple(r[p] for p in places) for r in cursor.fetchall()])
    assert expected, "a check on no rows says nothing"
    assert canonical([tuple(r[c] for c in columns) for r in df.collect()]) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0

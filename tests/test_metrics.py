import datetime

import pytest
from pyspark.sql import functions as F

from stepmark.operators import metrics as G

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(1, s, START + datetime.timedelta(seconds=s / 2), float(s)) for s in range(25)]
    rows.append((2, 0, START, 1.0))
    return spark.createDataFrame(rows, "run_id bigint, step bigint, ts timestamp, loss double")


def test_throughput(log):
    rows = {r["run_id"]: r for r in G.run_throughput(log, samples_per_step=8).collect()}
    assert (rows[1]["runtime"], rows[1]["steps"], rows[1]["mean_loss"]) == (12.0, 25, 12.0)
    assert rows[1]["steps_per_second"] == pytest.approx(25 / 12)
    assert rows[1]["samples_per_second"] == pytest.approx(200 / 12)
    assert rows[2]["runtime"] == 0 and rows[2]["steps_per_second"] is None and rows[2]["samples_per_second"] is None


def test_runtime_over_days(spark):
    rows = [(1, 0, START, 0.0), (1, 1, START + datetime.timedelta(days=40, hours=3, seconds=1.25), 0.0)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"run_id bigint, step bigint, ts {kind}, loss double")
        assert G.run_throughput(df, 1).first()["runtime"] == 40 * 86400 + 3 * 3600 + 1.25


def test_mean_of_every_n(log):
    got = {(r["run_id"], r["window"]): (r["mean_loss"], r["steps"]) for r in G.metric_every_n(log).collect()}
    assert got == {(1, 0): (4.5, 10), (1, 1): (14.5, 10), (1, 2): (22.0, 5), (2, 0): (1.0, 1)}


@pytest.mark.parametrize("block", [10, 13, 1000])
def test_rolling_mean_over_block_borders(log, block):
    got = {(r["run_id"], r["step"]): r["rolling_loss"] for r in G.rolling_metric(log, 4, block_steps=block).collect()}
    assert len(got) == 26
    for s in range(25):
        window = range(max(0, s - 3), s + 1)
        assert got[(1, s)] == pytest.approx(sum(window) / len(window))


def test_log_steps_number_each_run_in_time_order(spark):
    events = spark.range(300).select(
        (F.col("id") % 3).alias("run_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.hash("id"), F.lit(20_000))).alias("ts"),
    )
    rows = G.log_steps(events).collect()
    for run in range(3):
        part = sorted((r for r in rows if r["run_id"] == run), key=lambda r: (r["ts"], r["event_id"]))
        assert [r["step"] for r in part] == list(range(100))


def test_rolling_mean_over_steps_with_gaps(spark):
    rows = [(1, 10 * i, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "run_id long, step long, loss double")
    got = {r["step"]: r["rolling_loss"] for r in G.rolling_metric(df, n=4, block_steps=100).collect()}
    assert got == {10 * i: sum(range(max(0, i - 3), i + 1)) / len(range(max(0, i - 3), i + 1)) for i in range(40)}


def test_numbering_keeps_rows_with_null(spark):
    from stepmark.operators.numbering import number_by_blocks

    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (None, 5, 3)], "g long, b long, o long")
    got = {r["o"]: r["n"] for r in number_by_blocks(df, ["g"], "b", ["o"], "n").collect()}
    assert got == {1: 0, 2: 1, 3: 0}

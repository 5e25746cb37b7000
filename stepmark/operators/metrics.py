"""Reports over a training log (run_id, step, ts, loss)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepmark.operators.numbering import number_by_blocks, number_by_ranges

EVERY = 10  # fixed value: logged steps per mean


def _seconds(interval: Column) -> Column:
    """Length of a day-time interval; works for timestamps with and without time zone."""
    units = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    parts = [F.extract(F.lit(unit), interval).cast("double") * seconds for unit, seconds in units.items()]
    return sum(parts[1:], parts[0])


def run_throughput(log: DataFrame, samples_per_step: int) -> DataFrame:
    """Runtime, steps and samples per second, mean loss of each run; rates are NULL at zero runtime."""
    per_run = log.groupBy("run_id").agg(
        _seconds(F.max("ts") - F.min("ts")).alias("runtime"),
        F.count("*").alias("steps"),
        F.avg("loss").alias("mean_loss"),
    )
    rate = F.try_divide("steps", "runtime")
    return per_run.withColumns(
        {"steps_per_second": rate, "samples_per_second": rate * F.lit(samples_per_step)}
    )


def log_steps(log: DataFrame) -> DataFrame:
    """Number the rows of each run from 0 in time order, as `step` (ties by `event_id`).

    Runs are numbered by ranges of (run, time), so a run with a large share of the log is many
    sorts, however short it is.
    """
    return number_by_ranges(log, [F.asc("ts"), F.asc("event_id")], "step", ("run_id",))


def metric_every_n(log: DataFrame, n: int = EVERY) -> DataFrame:
    """Mean loss of each `n` steps of a run."""
    return log.groupBy("run_id", F.floor(F.col("step") / n).alias("window")).agg(
        F.avg("loss").alias("mean_loss"), F.count("*").alias("steps")
    )


def rolling_metric(log: DataFrame, n: int = EVERY, block_steps: int = 100_000) -> DataFrame:
    """Mean loss over each logged row and the n-1 rows before it; steps may have gaps.

    Rows are numbered first. A run is cut into blocks of `block_steps` rows; each block also gets
    the n-1 rows before it, which serve its first means and are then dropped. A long run is thus
    many bounded windows.
    """
    log = log.withColumn("_range", F.floor(F.col("step") / block_steps))
    log = number_by_blocks(log, ["run_id"], "_range", ["step"], "_number").drop("_range")
    place = F.pmod(F.col("_number"), F.lit(block_steps))
    own = F.floor(F.col("_number") / block_steps)
    blocks = F.when(place >= block_steps - (n - 1), F.array(own, own + 1)).otherwise(F.array(own))
    window = W.partitionBy("run_id", "_block").orderBy("_number").rowsBetween(-(n - 1), 0)
    return (
        log.withColumn("_block", F.explode(blocks))
        .withColumn("rolling_loss", F.avg("loss").over(window))
        .where(F.col("_block") == own)
        .drop("_block", "_number")
    )

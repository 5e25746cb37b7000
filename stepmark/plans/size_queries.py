"""Queries over image sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepmark.functions import numbers as N
from stepmark.functions import sizes as S
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query

_KEYS = "l_orderkey, l_linenumber"
KEYS = ["l_orderkey", "l_linenumber"]


def _factor_sql(name: str) -> str:
    def multiple(side: str) -> str:
        rounding = f"round_even({side}::DOUBLE / 28, 0)" if name == "round" else f"{name}({side}::DOUBLE / 28)"
        return f"({rounding} * 28)::BIGINT AS {side}"

    return f"WITH {sql.DIMS} SELECT {_KEYS}, {multiple('height')}, {multiple('width')} FROM dims"


def _factor(function):
    def run(spark, sf_dir):
        sides = {c: function(F.col(c), S.FACTOR) for c in ("height", "width")}
        return A.dims(spark, sf_dir).select(*KEYS, *[v.alias(c) for c, v in sides.items()])

    return run


query("round_by_factor", _factor_sql("round"))(_factor(N.round_by_factor))
query("ceil_by_factor", _factor_sql("ceil"))(_factor(N.ceil_by_factor))
query("floor_by_factor", _factor_sql("floor"))(_factor(N.floor_by_factor))


@query(
    "aspect_ratio_reject",
    f"""WITH {sql.DIMS} SELECT {_KEYS}, height, width FROM dims
WHERE greatest(height, width)::DOUBLE / least(height, width) > 200""",
)
def aspect_ratio_reject(spark, sf_dir):
    dims = A.dims(spark, sf_dir)
    return dims.where(S.aspect_ratio_reject(F.col("height"), F.col("width"))).select(*KEYS, "height", "width")


def _planned(plan):
    return [plan["height"].alias("new_height"), plan["width"].alias("new_width")]


@query(
    "resize_plan",
    f"""WITH {sql.DIMS} SELECT {_KEYS}, {sql.planned_side('height')} AS new_height,
{sql.planned_side('width')} AS new_width FROM dims""",
)
def resize_plan(spark, sf_dir):
    plan = S.resize_plan(F.col("height"), F.col("width"))
    return A.dims(spark, sf_dir).select(*KEYS, *_planned(plan))


_LOW = f"coalesce(min_pixels, {S.TRAINING_MIN_PIXELS})"
_HIGH = f"coalesce(max_pixels, {S.TRAINING_MAX_PIXELS})"


def _side(side: str) -> str:
    return sql.planned_side(side, low=_LOW, high=_HIGH)


@query(
    "pixel_budget",
    f"""WITH {sql.DIMS} SELECT {_KEYS}, ({_LOW})::BIGINT AS low, ({_HIGH})::BIGINT AS high,
{_side('height')} AS new_height, {_side('width')} AS new_width FROM dims""",
)
def pixel_budget(spark, sf_dir):
    low, high = S.pixel_budget(F.col("min_pixels"), F.col("max_pixels"), S.TRAINING)
    plan = S.resize_plan(F.col("height"), F.col("width"), low, high)
    return A.dims(spark, sf_dir).select(
        *KEYS, low.cast("bigint").alias("low"), high.cast("bigint").alias("high"), *_planned(plan)
    )


def _requested(side: str) -> str:
    asked = sql.planned_side(f"resized_{side}", "resized_height", "resized_width")
    low, high = f"coalesce(min_pixels, {S.CONVERSION_MIN_PIXELS})", f"coalesce(max_pixels, {S.CONVERSION_MAX_PIXELS})"
    own = sql.planned_side(side, low=low, high=high)
    return f"CASE WHEN resized_height IS NOT NULL AND resized_width IS NOT NULL THEN {asked} ELSE {own} END"


@query(
    "requested_size",
    f"""WITH {sql.DIMS} SELECT {_KEYS}, {_requested('height')} AS new_height,
{_requested('width')} AS new_width FROM dims""",
)
def requested_size(spark, sf_dir):
    columns = ["height", "width", "resized_height", "resized_width", "min_pixels", "max_pixels"]
    chosen = A.dims(spark, sf_dir).withColumns(S.requested_size(*[F.col(c) for c in columns]))
    plan = S.resize_plan(*[F.col(c) for c in ("plan_height", "plan_width", "plan_min", "plan_max")])
    return chosen.select(*KEYS, *_planned(plan))

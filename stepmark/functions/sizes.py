"""Image size planning: both sides multiples of a factor, area within bounds, aspect kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepmark.functions.numbers import ceil_by_factor, floor_by_factor, round_by_factor

# The planned sizes depend on them.
FACTOR = 28
MAX_ASPECT = 200
CONVERSION_MIN_PIXELS = 4 * 28 * 28
CONVERSION_MAX_PIXELS = 16384 * 28 * 28
TRAINING_MIN_PIXELS = 16 * 28 * 28
TRAINING_MAX_PIXELS = 256 * 28 * 28


@dataclass(frozen=True)
class PixelBounds:
    min_pixels: int
    max_pixels: int


CONVERSION = PixelBounds(CONVERSION_MIN_PIXELS, CONVERSION_MAX_PIXELS)
TRAINING = PixelBounds(TRAINING_MIN_PIXELS, TRAINING_MAX_PIXELS)


def aspect_ratio_reject(height: Column, width: Column) -> Column:
    """True where the sides cannot be planned: a side below 1, or longer than 200 times the other."""
    short, long = F.least(height, width), F.greatest(height, width)
    return (short < 1) | (long.cast("double") / F.nullif(short, F.lit(0)) > MAX_ASPECT)


def pixel_budget(min_pixels: Column, max_pixels: Column, default: PixelBounds = CONVERSION) -> tuple[Column, Column]:
    """Bounds of the row where given, else the default set."""
    return (
        F.coalesce(min_pixels, F.lit(default.min_pixels)),
        F.coalesce(max_pixels, F.lit(default.max_pixels)),
    )


def resize_plan(
    height: Column,
    width: Column,
    min_pixels: Column | None = None,
    max_pixels: Column | None = None,
    factor: int = FACTOR,
) -> Column:
    """struct(height, width) to resize to, NULL where `aspect_ratio_reject` holds.

    Rounded sides are taken if their area is within bounds. Too large: both sides are scaled
    down and floored, never under one factor. Too small: scaled up and ceiled. The bounds are
    a goal; the lower clamp can leave an area above the maximum.
    """
    low = F.lit(CONVERSION.min_pixels) if min_pixels is None else min_pixels
    high = F.lit(CONVERSION.max_pixels) if max_pixels is None else max_pixels
    area = height.cast("double") * width.cast("double")

    def rounded(side: Column) -> Column:
        return F.greatest(F.lit(factor), round_by_factor(side, factor))

    def shrunk(side: Column) -> Column:
        return F.greatest(F.lit(factor), floor_by_factor(side / F.sqrt(area / high), factor))

    def grown(side: Column) -> Column:
        return ceil_by_factor(side * F.sqrt(low / area), factor)

    rounded_area = rounded(height) * rounded(width)

    def planned(side: Column) -> Column:
        return (
            F.when(rounded_area > high, shrunk(side))
            .when(rounded_area < low, grown(side))
            .otherwise(rounded(side))
        )

    plan = F.struct(planned(height).alias("height"), planned(width).alias("width"))
    return F.when(~aspect_ratio_reject(height, width), plan)


def requested_size(
    height: Column,
    width: Column,
    resized_height: Column,
    resized_width: Column,
    min_pixels: Column,
    max_pixels: Column,
    default: PixelBounds = CONVERSION,
) -> dict[str, Column]:
    """What to plan from, as columns plan_height, plan_width, plan_min and plan_max.

    The requested sides if both are given, then with default bounds only; else the image's own
    sides and bounds. Add the columns first and plan from them after, so that each is computed
    once.
    """
    requested = resized_height.isNotNull() & resized_width.isNotNull()
    low, high = pixel_budget(min_pixels, max_pixels, default)
    return {
        "plan_height": F.when(requested, resized_height).otherwise(height),
        "plan_width": F.when(requested, resized_width).otherwise(width),
        "plan_min": F.when(requested, F.lit(default.min_pixels)).otherwise(low),
        "plan_max": F.when(requested, F.lit(default.max_pixels)).otherwise(high),
    }

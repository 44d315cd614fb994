"""Ratios and rounding. All ratios are DOUBLE and NULL on a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names of the variance classification (fixed values).
ABOVE = "Above Benchmark"
NEAR = "Near Benchmark"
BELOW = "Below Benchmark"


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def classify(pct: Column, upper: float = 2, lower: float = 0) -> Column:
    """Above ``upper``, below ``lower``, else near; NULL counts as near."""
    return (
        F.when(pct > F.lit(float(upper)), ABOVE)
        .when(pct < F.lit(float(lower)), BELOW)
        .otherwise(NEAR)
    )

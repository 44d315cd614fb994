"""D3, D4: charges against the benchmark of the parent group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import CONDITION
from ..functions.ratios import classify, ratio
from .stats import average_billing, total_billing, with_keys, with_parent


def _variance_pct(average: Column, benchmark: Column) -> Column:
    return F.try_divide(average - benchmark, benchmark) * F.lit(100.0)


def benchmark_variance(stats: DataFrame, parent: str = CONDITION) -> DataFrame:
    """Add average_billing, benchmark, variance_usd, variance_pct, peak_pct.

    The benchmark is the mean charge over all rows of the parent, not a mean of
    group means. ``peak_pct`` is the largest absolute percentage within the
    parent: for one benchmark it lies at the smallest or largest average, so
    the parent aggregate already holds it. Groups without a parent are dropped;
    a zero benchmark gives NULL percentages.
    """
    joined = with_parent(
        stats,
        parent,
        _sum=F.sum("bill_sum"),
        _rest=F.sum("bill_rest"),
        _n=F.sum("bill_n"),
        _low=F.min(average_billing()),
        _high=F.max(average_billing()),
    )
    groups = with_keys(joined, parent).select(
        *stats.columns,
        "_low",
        "_high",
        average_billing().alias("average_billing"),
        ratio(total_billing("_sum", "_rest"), F.col("_n")).alias("benchmark"),
    )
    average, benchmark = F.col("average_billing"), F.col("benchmark")
    low = F.abs(_variance_pct(F.col("_low"), benchmark))
    high = F.abs(_variance_pct(F.col("_high"), benchmark))
    return groups.select(
        *stats.columns,
        "average_billing",
        "benchmark",
        (average - benchmark).alias("variance_usd"),
        _variance_pct(average, benchmark).alias("variance_pct"),
        F.greatest(low, high).alias("peak_pct"),
    )


def classified_variance(variance: DataFrame, upper: float = 2, lower: float = 0) -> DataFrame:
    """Add the Above/Near/Below class of the unrounded percentage."""
    return variance.withColumn("classification", classify(F.col("variance_pct"), upper, lower))

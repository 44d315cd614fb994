"""D5, D6: shares of grand totals and their difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_days
from ..functions.ratios import percent
from .stats import grand_totals, patient_days


def share_of_total(measure: Column, total: Column) -> Column:
    """Percentage of ``total``; NULL if that is zero."""
    return percent(measure, total)


def share_totals(stats: DataFrame) -> Column:
    """Grand totals that ``share_difference`` divides by and compares with."""
    n, los = F.sum("n").cast("decimal(20,0)"), F.sum("los_ms")
    return grand_totals(
        stats,
        n=F.sum("n"),
        days=in_days(los),
        size=F.abs(los),
        signed_n=F.when(los > 0, n).when(los < 0, -n).otherwise(F.lit(0)),
    )


def share_difference(stats: DataFrame, totals: Column) -> DataFrame:
    """Add admission_share, patient_day_share, share_difference, over_share.

    ``totals`` are the ``share_totals`` of all groups. ``over_share`` says
    whether the difference is positive; it compares products of integers, so
    equal shares never differ by a floating-point remainder.
    """
    shares = stats.select(
        "*",
        share_of_total(F.col("n"), totals["n"]).alias("admission_share"),
        share_of_total(patient_days(), totals["days"]).alias("patient_day_share"),
    )
    n = F.col("n").cast("decimal(20,0)")
    return shares.select(
        "*",
        (F.col("patient_day_share") - F.col("admission_share")).alias("share_difference"),
        (F.col("los_ms") * totals["signed_n"] > n * totals["size"]).alias("over_share"),
    )

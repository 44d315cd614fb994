"""D7: groups above their share of patient-days and above their benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import COMBO
from .shares import share_difference, share_totals
from .stats import with_keys
from .variance import benchmark_variance


def priority_combos(stats: DataFrame, keys: tuple[str, ...] = COMBO) -> DataFrame:
    """Groups whose share difference and charge variance are both positive.

    ``keys[0]`` is the parent of the benchmark. Totals count all groups, also
    those with a NULL key, which are themselves never returned.
    """
    variance = benchmark_variance(stats, parent=keys[0])
    both = share_difference(variance, share_totals(stats))
    return with_keys(both, *keys).filter(F.col("over_share") & (F.col("variance_pct") > 0))

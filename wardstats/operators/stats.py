"""D2: the one wide aggregation, and everything read off its few rows.

A stats frame has one row per group with exact partials:

    n        rows                         BIGINT
    los_n    rows with a length of stay   BIGINT
    los_ms   their sum, milliseconds      DECIMAL(38,0)
    bill_n   rows with a charge           BIGINT
    bill_sum their sum                    DECIMAL(38,10)
    bill_rest sum of what that type cannot hold of them, DOUBLE

Sums are integers or decimals, so results do not depend on row order or on how
the data is split, and coarser groups follow from finer ones by adding up. Only
charges beyond 18 digits before the point or 10 after it add to ``bill_rest``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DAY_MS, in_days
from ..functions.ratios import ratio

LOS_TOTAL = "decimal(38,0)"
BILL_TOTAL = "decimal(38,10)"


def group_stats(facts: DataFrame, *by: str, los: bool = False, billing: bool = False) -> DataFrame:
    """Partials of ``facts`` per ``by`` (one row if no key is given).

    Each task first folds its rows to one row per key, so the shuffle carries
    at most tasks x keys rows however skewed the keys are.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    if los:
        # Days, seconds and milliseconds are summed apart: each sum fits a
        # BIGINT for trillions of rows, where one in milliseconds would not.
        parts += [
            F.count("los_ms").alias("los_n"),
            F.sum(F.expr(f"los_ms div {DAY_MS}")).alias("_days"),
            F.sum(F.expr(f"(los_ms % {DAY_MS}) div 1000")).alias("_secs"),
            F.sum(F.expr("los_ms % 1000")).alias("_millis"),
        ]
    if billing:
        parts += [F.count("billing").alias("bill_n"), F.sum("billing").alias("bill_sum"), F.sum("billing_rest").alias("bill_rest")]
    grouped = facts.groupBy(*by).agg(*parts)

    out = [*by, "n"]
    if los:
        wide = {c: F.col(c).cast("decimal(20,0)") for c in ("_days", "_secs", "_millis")}
        total = wide["_days"] * DAY_MS + wide["_secs"] * 1000 + wide["_millis"]
        out += ["los_n", total.cast(LOS_TOTAL).alias("los_ms")]
    if billing:
        out += ["bill_n", F.col("bill_sum").cast(BILL_TOTAL).alias("bill_sum"), "bill_rest"]
    return _one_shape(grouped.select(*out), los, billing)


def merge_stats(stats: DataFrame, *by: str, los: bool = False, billing: bool = False) -> DataFrame:
    """Partials per ``by`` from the partials of finer groups."""
    parts = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    if los:
        parts += [
            F.coalesce(F.sum("los_n"), F.lit(0)).alias("los_n"),
            F.sum("los_ms").cast(LOS_TOTAL).alias("los_ms"),
        ]
    if billing:
        parts += [
            F.coalesce(F.sum("bill_n"), F.lit(0)).alias("bill_n"),
            F.sum("bill_sum").cast(BILL_TOTAL).alias("bill_sum"),
            F.sum("bill_rest").alias("bill_rest"),
        ]
    return _one_shape(stats.groupBy(*by).agg(*parts), los, billing)


def _one_shape(stats: DataFrame, los: bool, billing: bool) -> DataFrame:
    """Make every reader of a stats frame need all its partials.

    A report reads the frame more than once: its rows, their totals, their
    per-condition sums. Column pruning would leave each reader an aggregate of
    its own, hence its own scan of the admissions. The filter below always
    holds, as counts are never negative, but names every partial: the readers'
    aggregates stay equal, and Spark runs their scan and shuffle once
    (ReusedExchange).
    """
    holds = [F.col("n") >= 0]
    if los:
        holds.append((F.col("los_n") >= 0) | F.col("los_ms").isNull())
    if billing:
        holds.append((F.col("bill_n") >= 0) | F.col("bill_sum").isNull() | F.col("bill_rest").isNull())
    return stats.filter(reduce(lambda a, b: a & b, holds))


def average_los() -> Column:
    return ratio(in_days(F.col("los_ms")), F.col("los_n"))


def patient_days() -> Column:
    return in_days(F.col("los_ms"))


def total_billing(exact: str = "bill_sum", rest: str = "bill_rest") -> Column:
    """DOUBLE sum of the charges, from their exact part and its rest."""
    return F.col(exact).cast("double") + F.coalesce(F.col(rest), F.lit(0.0))


def average_billing() -> Column:
    return ratio(total_billing(), F.col("bill_n"))


def with_keys(stats: DataFrame, *keys: str) -> DataFrame:
    """Drop groups with a NULL key, as an equality join on the keys would.

    Written on ``n`` so that it stays above the aggregation: pushed below, it
    would make this reader's scan differ from that of the grand totals, which
    count the dropped groups too.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return stats.filter(F.when(complete, F.col("n")) > 0)


def grand_totals(stats: DataFrame, **aggs: Column) -> Column:
    """Struct of aggregates over a whole stats frame, as a scalar subquery.

    Its single row is merged from one row per task, so no task ever holds the
    frame. Every use of a field plans the subquery again (though it runs once),
    so aggregates are best taken as far as they go in ``aggs``.
    """
    parts = [agg.alias(name) for name, agg in aggs.items()]
    return stats.agg(F.struct(*parts).alias("totals")).scalar()


def overall_los() -> Column:
    """Aggregate: mean stay over all rows behind a stats frame, in days."""
    return ratio(in_days(F.sum("los_ms")), F.sum("los_n"))


def with_parent(stats: DataFrame, parent: str, **aggs: Column) -> DataFrame:
    """Add per-``parent`` aggregates of a stats frame to each of its rows.

    An aggregation and a join rather than a window: a parent with very many
    groups is folded in every task before the shuffle, Spark broadcasts the
    parents only if their measured size is small, and otherwise splits a
    skewed partition of the join. NULL parents match (see ``with_keys``).
    """
    parents = stats.groupBy(F.col(parent).alias("_parent")).agg(
        *[agg.alias(name) for name, agg in aggs.items()]
    )
    return stats.join(parents, F.col(parent).eqNullSafe(F.col("_parent"))).drop("_parent")

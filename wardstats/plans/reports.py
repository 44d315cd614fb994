"""The 28 admission reports.

Each takes an ``AdmissionTable`` (or, but for the two that look at raw rows, a
``SummaryTable``) and returns a lazy DataFrame. Filters and classes use
unrounded values; rounding comes last. Ties in the requested order are broken
by the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import ADMISSION_TYPE, COMBO, CONDITION, PROVIDER
from ..functions.dates import in_days
from ..functions.ratios import ratio
from ..operators.facts import column_profile, los_sample
from ..operators.priority import priority_combos
from ..operators.shares import share_difference, share_of_total, share_totals
from ..operators.stats import (
    average_billing, average_los, grand_totals, overall_los, patient_days, total_billing, with_keys,
    with_parent,
)
from ..operators.variance import benchmark_variance, classified_variance


def _rounded(value: Column, places: int, name: str) -> Column:
    return F.round(value, places).alias(name)


def _count() -> Column:
    return F.col("n").alias("admission_count")


def _average_los(places: int = 1) -> Column:
    return _rounded(average_los(), places, "average_los")


def _total_days() -> Column:
    return _rounded(patient_days(), 0, "total_patient_days")


def _overall_los(stats: DataFrame) -> Column:
    return grand_totals(stats, los=overall_los())["los"]


# Data validation


def q01_column_profile(table) -> DataFrame:
    return column_profile(table.raw, table.cols)


def q02_los_sample(table) -> DataFrame:
    return los_sample(table.raw, table.cols)


def q03_overall_average_los(table) -> DataFrame:
    return table.by(los=True).select(_average_los())


# Admission volume and distribution


def q04_admissions_by_condition(table) -> DataFrame:
    stats = table.by(CONDITION)
    share = share_of_total(F.col("n"), grand_totals(stats, n=F.sum("n"))["n"])
    return stats.select(CONDITION, _count(), _rounded(share, 2, "pct_of_admissions")).orderBy(
        F.desc("admission_count"), CONDITION
    )


def q05_admission_types_within_condition(table) -> DataFrame:
    stats = with_parent(table.by(*COMBO), CONDITION, _of_condition=F.sum("n"))
    share = share_of_total(F.col("n"), F.col("_of_condition"))
    share = F.when(F.col(CONDITION).isNotNull(), share)
    return stats.select(*COMBO, _count(), _rounded(share, 2, "pct_of_condition")).orderBy(
        CONDITION, F.desc("admission_count"), ADMISSION_TYPE
    )


# Length of stay and utilization


def q06_average_los_by_combo(table) -> DataFrame:
    stats = table.by(*COMBO, los=True)
    return stats.select(*COMBO, _count(), _average_los()).orderBy(F.desc("average_los"), *COMBO)


def q07_combos_above_average_los(table) -> DataFrame:
    stats = table.by(*COMBO, los=True)
    above = stats.filter(average_los() > _overall_los(stats))
    return above.select(*COMBO, _count(), _average_los()).orderBy(F.desc("average_los"), *COMBO)


def q08_high_volume_high_los_combos(table) -> DataFrame:
    stats = table.by(*COMBO, los=True)
    complete = F.col(CONDITION).isNotNull() & F.col(ADMISSION_TYPE).isNotNull()
    mean_volume = ratio(F.sum("n"), F.count_if(complete))
    means = grand_totals(stats, volume=mean_volume, los=overall_los())
    high = stats.filter((F.col("n") > means["volume"]) & (average_los() > means["los"]))
    return high.select(*COMBO, _count(), _average_los()).orderBy(F.desc("admission_count"), *COMBO)


def q09_estimated_patient_days(table) -> DataFrame:
    estimate = _rounded(F.col("n") * average_los(), 0, "est_patient_days")
    return (
        table.by(*COMBO, los=True)
        .select(*COMBO, _count(), _average_los(), estimate)
        .orderBy(F.desc("est_patient_days"), *COMBO)
    )


def q10_total_patient_days(table) -> DataFrame:
    return (
        table.by(*COMBO, los=True)
        .select(*COMBO, _count(), _average_los(), _total_days())
        .orderBy(F.desc("total_patient_days"), *COMBO)
    )


def q11_utilization_by_provider(table) -> DataFrame:
    return (
        table.by(PROVIDER, los=True)
        .select(PROVIDER, _count(), _average_los(), _total_days())
        .orderBy(F.desc("total_patient_days"), PROVIDER)
    )


# Insurance and billing


def _billing(table, *keys: str) -> DataFrame:
    return (
        table.by(*keys, billing=True)
        .select(
            *keys,
            _count(),
            _rounded(average_billing(), 2, "average_billing"),
            _rounded(total_billing(), 2, "total_billing"),
        )
        .orderBy(F.desc("total_billing"), *keys)
    )


def q12_billing_by_provider(table) -> DataFrame:
    return _billing(table, PROVIDER)


def q13_billing_by_combo(table) -> DataFrame:
    return _billing(table, *COMBO)


# Billing benchmark and variance


def _against_benchmark() -> list[Column]:
    return [
        _rounded(F.col("average_billing"), 2, "average_billing"),
        _rounded(F.col("benchmark"), 2, "condition_benchmark"),
    ]


def _variance_usd() -> Column:
    return _rounded(F.col("variance_usd"), 2, "variance_usd")


def _variance_pct() -> Column:
    return _rounded(F.col("variance_pct"), 2, "variance_pct")


def _abs_variance_pct() -> Column:
    return _rounded(F.abs("variance_pct"), 2, "abs_variance_pct")


def _variance(stats: DataFrame) -> DataFrame:
    return classified_variance(benchmark_variance(stats))


def q14_combos_above_benchmark(table) -> DataFrame:
    above = _variance(table.by(*COMBO, billing=True)).filter(F.col("average_billing") > F.col("benchmark"))
    return above.select(*COMBO, _count(), *_against_benchmark()).orderBy(
        F.desc("average_billing"), *COMBO
    )


def q15_variance_usd(table) -> DataFrame:
    return (
        _variance(table.by(*COMBO, billing=True))
        .select(*COMBO, *_against_benchmark(), _variance_usd())
        .orderBy(F.desc("variance_usd"), *COMBO)
    )


def q16_variance_pct(table) -> DataFrame:
    return (
        _variance(table.by(*COMBO, billing=True))
        .select(*COMBO, *_against_benchmark(), _variance_usd(), _variance_pct())
        .orderBy(F.desc("variance_pct"), *COMBO)
    )


def q17_variance_classification(table) -> DataFrame:
    return (
        _variance(table.by(*COMBO, billing=True))
        .select(*COMBO, *_against_benchmark(), _variance_usd(), _variance_pct(), "classification")
        .orderBy(F.desc("variance_pct"), *COMBO)
    )


def q18_absolute_variance(table) -> DataFrame:
    return (
        _variance(table.by(*COMBO, billing=True))
        .select(
            *COMBO, *_against_benchmark(), _variance_usd(), _variance_pct(), _abs_variance_pct(),
            "classification",
        )
        .orderBy(F.desc("abs_variance_pct"), *COMBO)
    )


def q19_largest_variance_per_condition(table) -> DataFrame:
    largest = _variance(table.by(*COMBO, billing=True)).filter(F.abs("variance_pct") == F.col("peak_pct"))
    return largest.select(
        *COMBO, *_against_benchmark(), _variance_usd(), _variance_pct(), _abs_variance_pct()
    ).orderBy(*COMBO)


def _class_counts(stats: DataFrame) -> DataFrame:
    return _variance(stats).groupBy("classification").agg(F.count(F.lit(1)).alias("n_combos"))


def q20_combos_per_class(table) -> DataFrame:
    counts = _class_counts(table.by(*COMBO, billing=True))
    return counts.orderBy(F.desc("n_combos"), "classification")


def q21_class_shares(table) -> DataFrame:
    stats = table.by(*COMBO, billing=True)
    combos = grand_totals(with_keys(stats, CONDITION), combos=F.count(F.lit(1)))["combos"]
    share = share_of_total(F.col("n_combos"), combos)
    return (
        _class_counts(stats)
        .select("classification", "n_combos", _rounded(share, 2, "pct_of_combos"))
        .orderBy(F.desc("n_combos"), "classification")
    )


# Utilization and billing together


def q22_long_stay_above_benchmark(table) -> DataFrame:
    stats = table.by(*COMBO, los=True, billing=True)
    both = with_keys(benchmark_variance(stats), *COMBO).filter(
        (average_los() > _overall_los(stats)) & (F.col("variance_pct") > 0)
    )
    return both.orderBy(average_los().desc(), *COMBO).select(
        *COMBO, _count(), _average_los(2), _variance_pct()
    )


def q23_patient_days_above_benchmark(table) -> DataFrame:
    stats = table.by(*COMBO, los=True, billing=True)
    above = with_keys(benchmark_variance(stats), *COMBO).filter(F.col("variance_pct") > 0)
    return above.orderBy(F.desc("los_ms"), *COMBO).select(
        *COMBO, _count(), _total_days(), _variance_pct()
    )


def q24_patient_day_share(table) -> DataFrame:
    stats = table.by(*COMBO, los=True)
    total = grand_totals(stats, days=in_days(F.sum("los_ms")))["days"]
    share = share_of_total(patient_days(), total)
    return stats.orderBy(F.desc("los_ms"), *COMBO).select(
        *COMBO, _count(), _total_days(), _rounded(share, 2, "pct_of_days")
    )


def _shares(table) -> DataFrame:
    stats = table.by(*COMBO, los=True)
    return share_difference(stats, share_totals(stats))


def _share_columns() -> list[Column]:
    names = ("admission_share", "patient_day_share", "share_difference")
    return [_rounded(F.col(name), 2, name) for name in names]


def q25_over_share_combos(table) -> DataFrame:
    return (
        _shares(table)
        .filter("over_share")
        .select(*COMBO, _count(), _total_days(), *_share_columns())
        .orderBy(F.desc("share_difference"), *COMBO)
    )


def q26_longest_stay_over_share(table) -> DataFrame:
    return (
        _shares(table)
        .filter("over_share")
        .orderBy(average_los().desc(), *COMBO)
        .limit(1)
        .select(*COMBO, _count(), _average_los(2), *_share_columns())
    )


# Management priority


def q27_priority_combos(table) -> DataFrame:
    return (
        priority_combos(table.by(*COMBO, los=True, billing=True))
        .orderBy(F.desc("share_difference"), *COMBO)
        .select(
            *COMBO, _average_los(2), _share_columns()[-1], *_against_benchmark(), _variance_pct()
        )
    )


def q28_priority_condition(table) -> DataFrame:
    return (
        priority_combos(table.by(*COMBO, los=True, billing=True))
        .groupBy(CONDITION)
        .agg(F.sum("los_ms").alias("los_ms"))
        .orderBy(F.desc("los_ms"), CONDITION)
        .limit(1)
        .select(CONDITION, _rounded(patient_days(), 0, "combined_total_patient_days"))
    )


REPORTS = {name: fn for name, fn in list(globals().items()) if name.startswith("q") and callable(fn)}

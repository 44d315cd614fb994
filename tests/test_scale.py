"""Results must not depend on how rows are split, joined or pre-aggregated."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from wardstats_checks.compare import differences, rows_of_spark
from wardstats_checks.plans import executed
from tests.helpers import START, admission, dicts, sql_rows, table
from tests.test_plans import setting
from wardstats import REPORTS, AdmissionTable, SummaryTable
from wardstats.operators import (
    admission_facts, benchmark_variance, group_stats, share_difference, share_totals,
)

GROUPED = [n for n in REPORTS if n[:3] not in ("q01", "q02")]
KEYS = ("condition", "admission_type")


def random_rows(seed, rows=400):
    """Clean (condition, type, provider, los, bill); a third in one condition."""
    pick = random.Random(seed)

    def row():
        condition = "hot" if pick.random() < 1 / 3 else pick.choice(["a", "b", "c", None])
        return (
            condition, pick.choice(["u", "v", "w", "x", None]), pick.choice(["p", "q", None]),
            pick.choice([None, *range(-3, 60)]),
            pick.choice([None, 0, round(pick.uniform(-50, 90000), 2)]),
        )

    return [row() for _ in range(rows)]


def raw_table(spark, clean):
    return table(spark, [admission(c, t, los, bill, p) for c, t, p, los, bill in clean])


CLEAN = random_rows(3, rows=2000)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    admissions = raw_table(spark, CLEAN)
    path = str(tmp_path_factory.mktemp("summary") / "partials")
    admissions.summary().write.parquet(path)
    return admissions, SummaryTable(spark.read.parquet(path))


@pytest.mark.parametrize("name", GROUPED)
def test_random_rows_and_their_summary_equal_sql(stored, name):
    rows, summary = stored
    want = sql_rows(name, CLEAN)
    assert differences(rows_of_spark(REPORTS[name](rows)), want) is None
    assert differences(rows_of_spark(REPORTS[name](summary)), want) is None


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_split_of_rows_does_not_matter(stored, parts):
    rows, _ = stored
    for name in ("q16_variance_pct", "q25_over_share_combos", "q27_priority_combos"):
        split = AdmissionTable(rows.raw.repartition(parts))
        assert differences(rows_of_spark(REPORTS[name](split)), rows_of_spark(REPORTS[name](rows))) is None


def test_ansi_mode_does_not_matter(spark, stored):
    rows, _ = stored
    want = rows_of_spark(REPORTS["q27_priority_combos"](rows))
    with setting(spark, spark__sql__ansi__enabled="false"):
        got = rows_of_spark(REPORTS["q27_priority_combos"](AdmissionTable(rows.raw)))
    assert differences(got, want) is None


def test_shares_and_variances_add_up(stored):
    rows, _ = stored
    stats = rows.by(*KEYS, los=True, billing=True)
    shares = dicts(share_difference(stats, share_totals(stats)))
    for field, total in (("admission_share", 100), ("patient_day_share", 100), ("share_difference", 0)):
        assert sum(r[field] or 0 for r in shares) == pytest.approx(total)
    for row in shares:
        assert bool(row["over_share"]) == ((row["share_difference"] or 0) > 0)
    weighted = {}
    for row in dicts(benchmark_variance(stats)):
        sums = weighted.setdefault(row["condition"], [0.0, 0.0])
        sums[0] += (row["variance_usd"] or 0) * row["bill_n"]
        sums[1] += abs(row["variance_usd"] or 0) * row["bill_n"]
    assert all(abs(total) < 1e-9 * size for total, size in weighted.values())


def test_reports_agree_with_each_other(stored):
    rows, _ = stored

    def answer(name):
        return dicts(REPORTS[name](rows))

    classes = {r["classification"]: r["n_combos"] for r in answer("q20_combos_per_class")}
    assert classes == {r["classification"]: r["n_combos"] for r in answer("q21_class_shares")}
    assert sum(classes.values()) == len(answer("q17_variance_classification"))
    over = {(r["condition"], r["admission_type"]) for r in answer("q25_over_share_combos")}
    longest = answer("q26_longest_stay_over_share")
    assert {(r["condition"], r["admission_type"]) for r in longest} <= over and longest
    priority = answer("q27_priority_combos")
    assert answer("q28_priority_condition")[0]["condition"] in {r["condition"] for r in priority}


def test_largest_variances_with_ties_and_negative_benchmarks(spark):
    pick = random.Random(5)
    clean = [
        (f"c{pick.randrange(300)}", pick.choice("uvwxyz"), "p", 1, pick.choice([-6, -4, -3, -2, 1, 2, 4]))
        for _ in range(2500)
    ]
    name = "q19_largest_variance_per_condition"
    ours = rows_of_spark(REPORTS[name](raw_table(spark, clean)))
    assert differences(ours, sql_rows(name, clean)) is None
    conditions = [row[ours[0].index("condition")] for row in ours[1]]
    assert len(conditions) > len(set(conditions)) > 250


def test_hot_condition_with_many_groups_is_split(spark):
    """One condition holds most groups; its join partition is cut up."""
    raw = spark.range(120_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500))
        .alias("Medical Condition"),
        F.concat(F.lit("type-"), F.col("id")).alias("Admission Type"),
        (F.col("id") % 977).cast("string").alias("Billing Amount"),
    )
    stats = group_stats(admission_facts(raw), *KEYS, billing=True)
    with setting(
        spark,
        spark__sql__shuffle__partitions="8",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    ):
        variance = benchmark_variance(stats)
        plan = executed(variance.filter(F.col("condition") != "c1").select("admission_type", "variance_pct"))
        per_class = variance.agg(F.count("*").alias("n"), F.sum("bill_n").alias("b")).first()
    assert plan.skew_joins == 1
    assert (per_class.n, per_class.b) == (120_000, 120_000)


def test_sums_hold_for_very_long_and_odd_stays(spark):
    rows = [admission("a", "u", "9999-12-31 23:59:59.999", 1)] * 3 + [admission("a", "u", "0001-01-01", 1)]
    got = dicts(REPORTS["q10_total_patient_days"](table(spark, rows)))[0]["total_patient_days"]
    to_the_end = (date(9999, 12, 31) - START).days + 1
    assert got == 3 * to_the_end + (date(1, 1, 1) - START).days

"""Dirty values, NULLs, ties and thresholds, which the given tables lack."""

from decimal import Decimal

import pytest

from wardstats_checks.compare import differences, rows_of_spark
from tests.helpers import COLS, admission, dicts, sql_rows, table
from wardstats import REPORTS, AdmissionTable, ColumnMap, SummaryTable
from wardstats import operators as op
from wardstats.columns import COMBO

# Raw (condition, type, days, charge, provider) and its clean (days, charge).
MESSY = [
    (("Flu", "Urgent", 3, 100, "A"), (3, 100)),
    (("Flu", "Urgent", 5, 140, "B"), (5, 140)),
    (("Flu", "Urgent", "not a date", 90, "A"), (None, 90)),
    (("Flu", "Elective", 10, "$1,250.75", "A"), (10, Decimal("1250.75"))),
    (("Flu", "Elective", 2, None, None), (2, None)),
    (("Flu", None, 4, "abc", "B"), (4, 0)),
    (("Flu", None, 7, 333.25, "B"), (7, Decimal("333.25"))),
    ((None, "Urgent", 30, 900, "A"), (30, 900)),
    ((None, "Urgent", 1, 20, None), (1, 20)),
    ((None, None, 9, "12abc", "C"), (9, 12)),
    (("Cold", "Urgent", 6, 0, "C"), (6, 0)),
    (("Cold", "Elective", 8, "", "C"), (8, 0)),
    (("Gout", "Urgent", 12, 50, "A"), (12, 50)),
    (("Gout", "Elective", 0, 60, "B"), (0, 60)),
    (("Gout", "Elective", -2, 75.5, "B"), (-2, Decimal("75.5"))),
    (("Ache", "Urgent", 11, 500, "A"), (11, 500)),
    (("Rash", "Urgent", None, None, "A"), (None, None)),
]


@pytest.fixture(scope="module")
def messy(spark):
    return table(spark, [admission(c, t, d, b, p) for (c, t, d, b, p), _ in MESSY])


@pytest.mark.parametrize("name", [n for n in REPORTS if n[:3] not in ("q01", "q02")])
def test_messy_rows_equal_sql(messy, name):
    clean = [(c, t, p, los, bill) for (c, t, _, _, p), (los, bill) in MESSY]
    ours = rows_of_spark(REPORTS[name](messy))
    assert differences(ours, sql_rows(name, clean)) is None


@pytest.mark.parametrize("name", [n for n in REPORTS if n[:3] not in ("q01", "q02")])
def test_empty_table(spark, name):
    ours = rows_of_spark(REPORTS[name](table(spark, [])))
    assert ours[1] == ([(None,)] if name.startswith("q03") else [])


def test_null_keys_stay_or_go(messy):
    def conditions(name):
        return {r["condition"] for r in dicts(REPORTS[name](messy))}

    for name in ("q04_admissions_by_condition", "q05_admission_types_within_condition",
                 "q06_average_los_by_combo", "q09_estimated_patient_days",
                 "q10_total_patient_days", "q13_billing_by_combo", "q24_patient_day_share"):
        assert None in conditions(name), name
    for name in ("q15_variance_usd", "q16_variance_pct", "q17_variance_classification",
                 "q18_absolute_variance", "q19_largest_variance_per_condition"):
        assert None not in conditions(name), name
    kinds = {r["admission_type"] for r in dicts(REPORTS["q15_variance_usd"](messy))}
    assert None in kinds
    shares = dicts(REPORTS["q05_admission_types_within_condition"](messy))
    assert all((r["pct_of_condition"] is None) == (r["condition"] is None) for r in shares)


def test_profile_counts_nulls_and_unreadable_values(spark):
    rows = [
        admission("Flu", "Urgent", "31/01/2024", "abc"),
        admission(None, "Urgent", None, None),
        admission("Flu", None, "2024-01-09", "$3"),
        admission("Flu", None, "2024-1-9", "NaN"),
    ]
    profile = {r["column"]: r for r in dicts(REPORTS["q01_column_profile"](table(spark, rows)))}
    counts = {c: (r["type"], r["n_rows"], r["n_null"], r["n_invalid"]) for c, r in profile.items()}
    assert counts == {
        COLS.condition: ("string", 4, 1, 0),
        COLS.admission_type: ("string", 4, 2, 0),
        COLS.provider: ("string", 4, 0, 0),
        COLS.billing: ("string", 4, 1, 2),
        COLS.admit: ("string", 4, 0, 0),
        COLS.discharge: ("string", 4, 1, 2),
    }


def test_sample_shows_raw_dates_and_stay(spark):
    rows = [admission("Flu", "Urgent", d, 1) for d in (5, "x", None, 2)]
    assert [r["los"] for r in dicts(REPORTS["q02_los_sample"](table(spark, rows)))] == [
        None, 2.0, 5.0, None,
    ]


def test_estimate_differs_from_sum_when_a_stay_is_missing(spark):
    t = table(spark, [admission("Flu", "Urgent", d, 1) for d in (4, 6, "?")])
    assert dicts(REPORTS["q09_estimated_patient_days"](t))[0]["est_patient_days"] == 15.0
    assert dicts(REPORTS["q10_total_patient_days"](t))[0]["total_patient_days"] == 10.0


def test_stays_keep_the_time_of_day(spark):
    t = table(spark, [
        admission("Flu", "Urgent", "2024-01-02 12:00", 1),
        admission("Flu", "Urgent", "2024-01-02", 1),
    ])
    row = dicts(REPORTS["q10_total_patient_days"](t))[0]
    assert (row["average_los"], row["total_patient_days"]) == (1.3, 3.0)


def test_ties_for_the_largest_variance_are_all_returned(spark):
    t = table(spark, [
        admission("Flu", "Urgent", 1, 90), admission("Flu", "Elective", 1, 110),
        admission("Flu", "Emergency", 1, 100),
        admission("Cold", "Urgent", 1, 5),
    ])
    rows = dicts(REPORTS["q19_largest_variance_per_condition"](t))
    assert [(r["condition"], r["admission_type"], r["variance_pct"]) for r in rows] == [
        ("Cold", "Urgent", 0.0), ("Flu", "Elective", 10.0), ("Flu", "Urgent", -10.0),
    ]


def test_class_boundaries(spark):
    # Benchmarks of 100: exactly 2 and 0 are near, just beyond is not.
    t = table(spark, [
        admission("two", "u", 1, 102), admission("two", "v", 1, 98),
        admission("more", "u", 1, "102.0001"), admission("more", "v", 1, "97.9999"),
        admission("zero", "u", 1, 100), admission("zero", "v", 1, 100),
        admission("none", "u", 1, 0), admission("none", "v", 1, 0),
    ])
    got = {
        (r["condition"], r["admission_type"]): (r["classification"], r["variance_pct"])
        for r in dicts(REPORTS["q17_variance_classification"](t))
    }
    assert got == {
        ("two", "u"): ("Near Benchmark", 2.0), ("two", "v"): ("Below Benchmark", -2.0),
        ("more", "u"): ("Above Benchmark", 2.0), ("more", "v"): ("Below Benchmark", -2.0),
        ("zero", "u"): ("Near Benchmark", 0.0), ("zero", "v"): ("Near Benchmark", 0.0),
        ("none", "u"): ("Near Benchmark", None), ("none", "v"): ("Near Benchmark", None),
    }


def test_zero_benchmark_is_absent_from_ranked_reports(spark):
    t = table(spark, [admission("none", k, d, 0) for k, d in (("u", 9), ("v", 1))])
    for name in ("q14_combos_above_benchmark", "q19_largest_variance_per_condition",
                 "q22_long_stay_above_benchmark", "q23_patient_days_above_benchmark",
                 "q27_priority_combos", "q28_priority_condition"):
        assert dicts(REPORTS[name](t)) == [], name


@pytest.mark.parametrize("days", [(1, 1), (7, 7), (0, 0)])
def test_equal_shares_are_not_over_share(spark, days):
    rows = [admission("Flu", k, d, 1) for k, d in zip("uv", days) for _ in range(3)]
    for name in ("q25_over_share_combos", "q26_longest_stay_over_share"):
        assert dicts(REPORTS[name](table(spark, rows))) == []


def test_negative_total_of_days_turns_the_comparison(spark):
    t = table(spark, [admission("Flu", "u", -9, 1), admission("Flu", "v", 1, 1)])
    assert [r["admission_type"] for r in dicts(REPORTS["q25_over_share_combos"](t))] == ["u"]


def test_top_one_ties_go_to_the_first_key(spark):
    rows = [admission(c, "u", 9, 1) for c in ("Flu", "Cold")] + [admission("Ache", "u", 1, 1)]
    assert dicts(REPORTS["q26_longest_stay_over_share"](table(spark, rows)))[0]["condition"] == "Cold"


def test_reports_are_ordered(messy):
    def column(name, field):
        return [r[field] for r in dicts(REPORTS[name](messy))]

    for name, field in (
        ("q04_admissions_by_condition", "admission_count"),
        ("q06_average_los_by_combo", "average_los"),
        ("q12_billing_by_provider", "total_billing"),
        ("q16_variance_pct", "variance_pct"),
        ("q18_absolute_variance", "abs_variance_pct"),
        ("q24_patient_day_share", "total_patient_days"),
        ("q25_over_share_combos", "share_difference"),
    ):
        values = column(name, field)
        present = [v for v in values if v is not None]
        assert present == sorted(present, reverse=True), name
        assert values[: len(present)] == present, name
    conditions = column("q05_admission_types_within_condition", "condition")
    assert conditions == sorted(conditions, key=lambda c: (c is not None, c))


def test_charges_of_any_size_count_in_totals_and_averages(spark):
    rows = [admission("A", "x", 1, c) for c in ("$1e18", "1e-12", "2.50")] + [admission("B", "x", 1, "1e-12")]
    wide = table(spark, rows)
    for source in (wide, SummaryTable(wide.summary())):
        got = {r["condition"]: r for r in dicts(op.benchmark_variance(source.by(*COMBO, billing=True)))}
        assert got["A"]["average_billing"] == got["A"]["benchmark"] == (1e18 + 2.5 + 1e-12) / 3
        assert got["B"]["benchmark"] == 1e-12
        assert [r["total_billing"] for r in dicts(REPORTS["q13_billing_by_combo"](source))] == [1e18, 0.0]


def test_a_missing_mapped_column_is_named(spark):
    raw = table(spark, [admission("A", "x", 1, 5)]).raw.drop(COLS.provider)
    assert len(dicts(REPORTS["q13_billing_by_combo"](AdmissionTable(raw)))) == 1
    with pytest.raises(ValueError, match="Insurance Provider.*ColumnMap.provider"):
        REPORTS["q12_billing_by_provider"](AdmissionTable(raw))
    with pytest.raises(ValueError, match="'Charge'.*ColumnMap.billing"):
        REPORTS["q13_billing_by_combo"](AdmissionTable(raw, ColumnMap(billing="Charge")))

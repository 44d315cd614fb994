"""Every registered query against its SQL on the given tables, and its plan."""

import pytest

import __spark_entry__ as contract
from wardstats_checks.compare import differences, duckdb_over, rows_of_spark, rows_of_sql
from wardstats_checks.plans import plan_of
from tests.test_plans import check
from wardstats import REPORTS

FOLDER = "/root/testdata/sf0.001"
# The corpus operators, where they are present, have tests of their own.
ADMISSIONS = [n for n in contract.queries() if n not in {*contract.CORPUS, "pipeline"}]


@pytest.fixture(scope="module")
def con():
    return duckdb_over(FOLDER)


def test_all_reports_are_registered():
    assert len(REPORTS) == 28
    assert sorted(n[:3] for n in REPORTS) == [f"q{i:02d}" for i in range(1, 29)]
    assert set(ADMISSIONS) == contract.oracle_sql().keys() - {*contract.CORPUS, "pipeline"}
    assert len(ADMISSIONS) == 36 + len(contract.SUMMARIZED)
    assert set(REPORTS) < set(contract.queries())


@pytest.mark.parametrize("name", ADMISSIONS)
def test_query_equals_sql_and_scans_each_table_once(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    ours = rows_of_spark(df)
    assert ours[1], "no rows"
    assert differences(ours, rows_of_sql(con, contract.oracle_sql()[name])) is None
    check(plan_of(df), name)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 4
    assert df.columns == [
        "condition", "admission_type", "average_los", "share_difference", "average_billing",
        "condition_benchmark", "variance_pct",
    ]

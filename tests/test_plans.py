"""Shape of the executed plans, on which the cost at scale depends."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as contract
from wardstats_checks.plans import executed

FOLDER = "/root/testdata/sf0.001"
TABLES = {"lineitem": 1, "orders": 1, "customer": 1, "part": 1}


@contextlib.contextmanager
def setting(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def check(plan, name):
    assert plan.scans == TABLES
    for node in plan.nodes:
        assert not re.search("Window|Python|Pandas|Cartesian|NestedLoop", node), node


@pytest.mark.parametrize(
    "name",
    ["q05_admission_types_within_condition", "q08_high_volume_high_los_combos",
     "q21_class_shares", "q22_long_stay_above_benchmark", "q28_priority_condition"],
)
def test_each_table_is_scanned_once_with_shuffled_joins(spark, name):
    with setting(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = executed(contract.queries()[name](spark, FOLDER))
    check(plan, name)
    assert plan.nodes["BroadcastHashJoinExec"] == 0


@pytest.mark.parametrize("name", ["q22_long_stay_above_benchmark", "q27_priority_combos"])
def test_each_table_is_scanned_once_without_adaptive_plans(spark, name):
    with setting(spark, spark__sql__adaptive__enabled="false"):
        check(executed(contract.queries()[name](spark, FOLDER)), name)


def test_a_reader_that_needs_less_still_shares_the_scan(spark):
    query = contract.queries()["q05_admission_types_within_condition"]
    check(executed(query(spark, FOLDER).groupBy().count()), "q05")


@pytest.mark.parametrize("name", ["q01_column_profile", "q27_priority_combos", "admission_facts"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    text = io.StringIO()
    with setting(spark, spark__sql__adaptive__enabled="false"), contextlib.redirect_stdout(text):
        contract.queries()[name](spark, FOLDER).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_reports_read_only_the_columns_they_need(spark):
    def columns(name):
        text = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        return set(re.findall(r"\bl_\w+(?=:)", " ".join(re.findall(r"ReadSchema: (.*)", text))))

    keys = {"l_partkey", "l_orderkey"}  # of the joins that make an admission
    assert columns("q04_admissions_by_condition") == keys
    assert columns("q10_total_patient_days") == keys | {"l_returnflag", "l_shipdate", "l_quantity"}
    assert columns("q13_billing_by_combo") == keys | {"l_returnflag", "l_extendedprice"}

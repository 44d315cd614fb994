import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from wardstats_checks.compare import differences, rows_of_spark, rows_of_sql
from wardstats_checks.oracle import statement
from tests.helpers import COLS, admission, dicts, table
from wardstats import REPORTS, AdmissionTable, ColumnMap, read_admissions

ROWS = [
    admission("Flu", "Urgent", 3, 1234.5), admission("Flu", "Elective", 5, 99),
    admission("Cold", "Urgent", "bad", 10), admission(None, "Urgent", 8, "$7,000.25"),
]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats_give_the_same_report(spark, tmp_path, fmt):
    source = table(spark, ROWS)
    path = str(tmp_path / fmt)
    options = {"header": True} if fmt == "csv" else {}
    source.raw.write.format(fmt).options(**options).save(path)
    read = read_admissions(spark, path, fmt)
    assert {f.dataType.simpleString() for f in read.schema.fields} == {"string"}
    for name in ("q13_billing_by_combo", "q10_total_patient_days"):
        got, want = (rows_of_spark(REPORTS[name](t)) for t in (AdmissionTable(read), source))
        assert differences(got, want) is None


def test_other_column_names_and_extra_columns(spark):
    names = ColumnMap("dx.code", "type", "payer %", "charge $", "in", "out")
    old = table(spark, ROWS).raw
    new = old.toDF("dx.code", "type", "payer %", "charge $", "in", "out").withColumn(
        "unused", F.lit(1)
    )
    got = AdmissionTable(new, names)
    assert len(dicts(REPORTS["q01_column_profile"](got))) == 7
    for name in ("q12_billing_by_provider", "q16_variance_pct", "q27_priority_combos"):
        want = rows_of_spark(REPORTS[name](table(spark, ROWS)))
        assert differences(rows_of_spark(REPORTS[name](got)), want) is None


def test_typed_columns_give_the_same_report(spark):
    clean = [r for r in ROWS if r[5] != "bad"]
    typed = table(spark, clean).raw
    typed = typed.withColumns({
        COLS.billing: typed[COLS.billing].substr(2, 20).try_cast("double"),
        COLS.admit: typed[COLS.admit].cast("timestamp_ntz"),
        COLS.discharge: typed[COLS.discharge].cast("date"),
    })
    plain = table(spark, [r for r in clean if "," not in r[3]])
    got = AdmissionTable(typed.filter(typed[COLS.billing].isNotNull()))
    for name in ("q10_total_patient_days", "q13_billing_by_combo"):
        assert differences(rows_of_spark(REPORTS[name](got)), rows_of_spark(REPORTS[name](plain))) is None


def test_table_without_provider_serves_the_other_reports(spark):
    raw = table(spark, ROWS).raw.drop(COLS.provider)
    assert len(dicts(REPORTS["q10_total_patient_days"](AdmissionTable(raw)))) == 4


def test_column_names_are_found_in_any_case(spark):
    raw = table(spark, [admission("Flu", "Urgent", "x", "y")]).raw
    lower = AdmissionTable(raw.toDF(*[c.lower() for c in raw.columns]))
    assert dicts(REPORTS["q13_billing_by_combo"](lower))[0]["total_billing"] == 0.0
    assert sum(r["n_invalid"] for r in dicts(REPORTS["q01_column_profile"](lower))) == 2


def test_csv_files_with_another_header_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join([COLS.condition, COLS.admission_type]) + "\nFlu,Urgent\n")
    (tmp_path / "b.csv").write_text(",".join([COLS.admission_type, COLS.condition]) + "\nUrgent,Flu\n")
    with pytest.raises(Exception, match="header"):
        read_admissions(spark, str(tmp_path), "csv").collect()


def test_json_numbers_keep_every_digit_and_cost_no_job(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(f'{{"{COLS.billing}": 12345678901234567.8912}}\n{{"{COLS.billing}": 12345678901234567.89}}\n')
    read = read_admissions(spark, str(path), "json")
    assert {r[COLS.billing] for r in read.collect()} == {"12345678901234567.8912", "12345678901234567.89"}
    assert all(f.dataType.simpleString() == "string" for f in read.schema.fields)


def test_an_admission_needs_its_part_order_and_customer(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    keep = {"lineitem": "true", "orders": "true", "part": "p_partkey % 10 <> 0", "customer": "c_custkey % 7 <> 0"}
    for name, rule in keep.items():
        spark.read.parquet(f"{folder}/{name}.parquet").where(rule).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in keep:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("q03_overall_average_los", "q04_admissions_by_condition", "q11_utilization_by_provider", "share_difference"):
        name = next(q for q in contract.queries() if q.startswith(name.split("_")[0] + "_") or q == name)
        got = rows_of_spark(contract.queries()[name](spark, str(tmp_path)))
        assert differences(got, rows_of_sql(con, statement(name))) is None, name

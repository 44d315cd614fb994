"""Small admission tables, and their answers from SQL."""

from __future__ import annotations

from datetime import date, timedelta

import duckdb
import pandas as pd
from pyspark.sql import types as T

from wardstats_checks.compare import rows_of_sql
from wardstats_checks.oracle import statement
from wardstats import AdmissionTable, ColumnMap

COLS = ColumnMap()
RAW_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        COLS.condition, COLS.admission_type, COLS.provider, COLS.billing, COLS.admit, COLS.discharge
    )
])
START = date(2024, 1, 1)


def admission(condition, kind, days, charge, provider="P"):
    """A raw row; ``days`` or ``charge`` may be None or text to be taken as is."""
    bad_date = days is None or isinstance(days, str)
    discharge = days if bad_date else str(START + timedelta(days=days))
    bill = charge if charge is None or isinstance(charge, str) else f"${charge:,.2f}"
    return (condition, kind, provider, bill, str(START), discharge)


def table(spark, rows) -> AdmissionTable:
    return AdmissionTable(spark.createDataFrame(rows, RAW_SCHEMA))


def sql_rows(name, clean):
    """Answer of a question over (condition, type, provider, los, bill) rows."""
    frame = pd.DataFrame(clean, columns=["condition", "admission_type", "provider", "los", "bill"])
    frame = frame.astype(object).where(frame.notna(), None)
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE fixture (condition VARCHAR, admission_type VARCHAR, provider VARCHAR, "
        "los DOUBLE, bill DECIMAL(18, 2))"
    )
    if len(frame):
        con.executemany("INSERT INTO fixture VALUES (?, ?, ?, ?, ?)", frame.values.tolist())
    return rows_of_sql(con, statement(name, "adm AS (SELECT * FROM fixture)"))


def dicts(df):
    return [row.asDict() for row in df.collect()]

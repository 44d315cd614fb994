"""D1: raw admission rows to typed facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import ColumnMap, raw_column, same_name, type_of
from ..functions.dates import epoch_millis, in_days, los_millis
from ..functions.money import clean_currency, currency_rest, is_bad_currency


def admission_facts(raw: DataFrame, cols: ColumnMap = ColumnMap()) -> DataFrame:
    """condition, admission_type, provider, los_ms BIGINT, billing DECIMAL(28,10),
    billing_rest DOUBLE (what that decimal cannot hold, else NULL or 0).

    A narrow projection: a report that reads two of the facts makes the scan
    read, and the parser parse, only those. Fields the raw table lacks are
    left out, so a table without a provider still serves the other reports.
    """
    facts = [
        raw_column(source).alias(name)
        for name, source in cols.dimensions().items()
        if type_of(raw, source)
    ]
    if type_of(raw, cols.admit) and type_of(raw, cols.discharge):
        facts.append(_stay(raw, cols).alias("los_ms"))
    if type_of(raw, cols.billing):
        charge = raw_column(cols.billing), type_of(raw, cols.billing)
        facts += [clean_currency(*charge).alias("billing"), currency_rest(*charge).alias("billing_rest")]
    return raw.select(*facts)


def _stay(raw: DataFrame, cols: ColumnMap) -> Column:
    return los_millis(
        raw_column(cols.admit), type_of(raw, cols.admit),
        raw_column(cols.discharge), type_of(raw, cols.discharge),
    )


def column_profile(raw: DataFrame, cols: ColumnMap = ColumnMap()) -> DataFrame:
    """Type, row count, NULLs and unreadable values of every raw column.

    One pass over the table: all counts come from one aggregate, whose single
    row is then turned into one row per column.
    """
    counts, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for i, field in enumerate(raw.schema.fields):
        value = raw_column(field.name)
        if same_name(field.name, cols.admit) or same_name(field.name, cols.discharge):
            bad = value.isNotNull() & epoch_millis(value, field.dataType).isNull()
        elif same_name(field.name, cols.billing):
            bad = is_bad_currency(value, field.dataType)
        else:
            bad = F.lit(False)
        counts += [F.count_if(value.isNull()).alias(f"null_{i}"), F.count_if(bad).alias(f"bad_{i}")]
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("n_rows"),
                F.col(f"null_{i}").alias("n_null"),
                F.col(f"bad_{i}").alias("n_invalid"),
            )
        )
    return raw.agg(*counts).select(F.inline(F.array(*rows)))


def los_sample(raw: DataFrame, cols: ColumnMap = ColumnMap(), rows: int = 10) -> DataFrame:
    """The first ``rows`` admissions by date with their length of stay in days.

    The stay follows from the two dates, so they alone order the rows, and only
    the rows kept are parsed.
    """
    admit, discharge = raw_column(cols.admit), raw_column(cols.discharge)
    return (
        raw.orderBy(admit, discharge)
        .limit(rows)
        .select(
            admit.alias("admit"), discharge.alias("discharge"),
            in_days(_stay(raw, cols)).alias("los"),
        )
    )

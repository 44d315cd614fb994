"""Raw admission tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..columns import ColumnMap


def read_admissions(
    spark: SparkSession, path: str, fmt: str = "parquet", cols: ColumnMap = ColumnMap(),
    extra: tuple[str, ...] = (), **options,
) -> DataFrame:
    """Raw admissions from ``parquet``, ``orc``, ``json`` or headed ``csv`` files.

    Text formats are read as text, without a pass to infer types: cleaning the
    text is the job of ``admission_facts``. All CSV files must have the first
    one's header; another one fails the read. A blank CSV field is NULL. JSON
    fields are those of ``cols`` and ``extra``, by name, numbers to the last digit.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": True, **options}
        header = spark.read.format(fmt).options(**options).load(path).schema
        reader = reader.schema(header).option("enforceSchema", False)
    elif fmt == "json":
        names = [cols.condition, cols.admission_type, cols.provider, cols.billing, cols.admit, cols.discharge, *extra]
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reader.options(**options).load(path)

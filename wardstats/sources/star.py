"""Admission rows laid out as a star of order tables.

A line item is one admission: part type = condition, return flag = admission
type, customer segment = provider, price = charge, ship date = admission, and
quantity = days stayed. Charges and dates are written as text, as an imported
file would hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import ColumnMap


def star_admissions(spark: SparkSession, folder: str, cols: ColumnMap = ColumnMap()) -> DataFrame:
    """Raw admissions from the tables in ``folder``.

    An admission is a line item with its part, its order and that order's
    customer; one that lacks any of them is none, whatever columns are read
    later. Join strategies are left to Spark, which broadcasts a table only if
    its size allows and splits skewed keys.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    # Orders meet customers first, so the line items shuffle only once for them.
    payers = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = table("lineitem").join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(payers.select("o_orderkey", "c_mktsegment"), F.col("l_orderkey") == F.col("o_orderkey"))
    admit = F.to_date("l_shipdate")
    return rows.select(
        F.col("l_returnflag").alias(cols.admission_type),
        F.col("p_type").alias(cols.condition),
        F.col("c_mktsegment").alias(cols.provider),
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias(cols.billing),
        admit.cast("string").alias(cols.admit),
        F.date_add(admit, F.col("l_quantity").cast("int")).cast("string").alias(cols.discharge),
    )

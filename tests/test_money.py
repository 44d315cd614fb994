from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstats.functions import clean_currency, currency_rest, is_bad_currency
from wardstats.operators import total_billing

# text -> (amount, counted as unreadable)
TEXTS = {
    "$1,234.50": ("1234.5", False),
    "12abc": ("12", False),
    "12f": ("12", False),
    "12d": ("12", False),
    "1.2.3": ("1.2", False),
    "": ("0", True),
    "abc": ("0", True),
    "($1.00)": ("0", True),
    "NaN": ("0", True),
    "Infinity": ("0", True),
    None: (None, False),
    "-$5.25": ("-5.25", False),
    " 7.5 ": ("7.5", False),
    "1e3": ("1000", False),
    "1e": ("1", False),
    "1.5e2x": ("150", False),
    ".5": ("0.5", False),
    "5.": ("5", False),
    "+3": ("3", False),
    "-": ("0", True),
    "0x10": ("0", False),
    "$ 12": ("12", False),
    "18856.281305978155": ("18856.2813059782", False),
    "999999999999999999": ("999999999999999999", False),
}


def test_currency_text(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select(
        "t",
        clean_currency(F.col("t"), T.StringType()).alias("v"),
        is_bad_currency(F.col("t"), T.StringType()).alias("bad"),
    ).collect()
    for row in got:
        amount, bad = TEXTS[row.t]
        assert row.v == (None if amount is None else Decimal(amount)), row.t
        assert row.bad is bad, row.t


# text -> (exact part, both parts)
BEYOND = {
    "1e18": ("0", 1e18), "$-1e30": ("0", -1e30), "1e-12": ("0", 1e-12), "1e-25x": ("0", 1e-25),
    "18856.281305978155": ("18856.2813059782", 18856.281305978155), "1.5": ("1.5", 1.5), "x": ("0", 0.0), None: (None, None),
}


def test_charges_beyond_the_decimal_have_a_rest(spark):
    df = spark.createDataFrame([(t,) for t in BEYOND], "t string")
    text = F.col("t"), T.StringType()
    rows = df.select(
        "t", clean_currency(*text).alias("billing"), currency_rest(*text).alias("billing_rest"), is_bad_currency(*text).alias("bad")
    ).select("*", total_billing("billing", "billing_rest").alias("both")).collect()
    for row in rows:
        part, both = BEYOND[row.t]
        assert (row.billing, row.both) == (None if part is None else Decimal(part), both), row
        assert row.bad is (row.t == "x"), row
        assert row.t not in ("1.5", None) or not row.billing_rest


@pytest.mark.parametrize("number", [1e18, 1e-12, 0.1, 1234.56])
def test_numbers_beyond_the_decimal_have_a_rest(spark, number):
    df = spark.createDataFrame([(number,)], "n double")
    value = F.col("n"), T.DoubleType()
    row = df.select(clean_currency(*value).alias("billing"), currency_rest(*value).alias("billing_rest"))
    assert row.select(total_billing("billing", "billing_rest").alias("v")).first().v == number


@pytest.mark.parametrize("kind", ["double", "float", "int", "decimal(12,2)"])
def test_numeric_charges(spark, kind):
    df = spark.createDataFrame([("12.5",), (None,)], "t string").select(
        F.col("t").cast("double").cast(kind).alias("n")
    )
    rows = df.select(clean_currency(F.col("n"), df.schema["n"].dataType).alias("v")).collect()
    assert [r.v for r in rows] == [Decimal(12 if kind == "int" else "12.5"), None]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),)], "n double")
    assert df.select(clean_currency(F.col("n"), T.DoubleType()).alias("v")).first().v is None


def test_only_ascii_digits_and_blanks_count(spark):
    texts = ["\u0661\u0662", "1\u0662", "\u00a05", " 5", "\x015"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        clean_currency(F.col("t"), T.StringType()).cast("double"), is_bad_currency(F.col("t"), T.StringType())
    ).collect()
    assert [tuple(r) for r in rows] == [(0.0, True), (1.0, False), (0.0, True), (5.0, False), (0.0, True)]

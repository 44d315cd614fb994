"""Charges: currency text or numbers to an exact decimal and, where that can't hold them, a rest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(28, 10)

# Longest leading number of a text, as a text-to-real cast reads it (fixed value).
LEADING_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


# Texts that one cast reads exactly.
PLAIN_TEXT = r"^[+-]?\d{1,18}(?:\.\d{1,10})?$"


def _bare(text: Column) -> Column:
    empty = F.lit("")
    return F.replace(F.replace(text, F.lit("$"), empty), F.lit(","), empty)


def _plain_number(bare: Column) -> Column:
    return F.when(bare.rlike(PLAIN_TEXT), bare.try_cast(MONEY))


def _leading_number(bare: Column) -> Column:
    return F.regexp_extract(bare, LEADING_NUMBER, 1)


def _always_exact(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.DecimalType):
        return dtype.scale <= MONEY.scale and dtype.precision - dtype.scale <= MONEY.precision - MONEY.scale
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType))


def clean_currency(value: Column, dtype: T.DataType) -> Column:
    """Charge as DECIMAL(28,10), as far as that holds it; ``currency_rest`` is what is left.

    Text loses ``$`` and ``,``; then its longest leading number counts, and a
    text with none counts as 0 (NULL and NaN are NULL). Plain numbers take one
    cast, the regular expression only sees what that refuses. A number too
    large for the type is 0 here and wholly in the rest.
    """
    zero = F.lit(0).cast(MONEY)
    if isinstance(dtype, T.StringType):
        bare = _bare(value)
        amount = F.coalesce(_plain_number(bare), _leading_number(bare).try_cast(MONEY), zero)
        return F.when(value.isNotNull(), amount)
    return F.when(_number(value, dtype).isNotNull(), F.coalesce(value.try_cast(MONEY), zero))


def currency_rest(value: Column, dtype: T.DataType) -> Column:
    """What ``clean_currency`` leaves of a charge, as DOUBLE; NULL or 0 if that holds all of it.

    Both together are the charge as a DOUBLE has it: 1e18, 1e-12, or the digits
    beyond the tenth.
    """
    if _always_exact(dtype):
        return F.lit(None).cast("double")
    exact = clean_currency(value, dtype).cast("double")
    if isinstance(dtype, T.StringType):
        bare = _bare(value)
        return F.when(~bare.rlike(PLAIN_TEXT), F.coalesce(_leading_number(bare).try_cast("double"), F.lit(0.0)) - exact)
    return _number(value, dtype).cast("double") - exact


def is_bad_currency(value: Column, dtype: T.DataType) -> Column:
    """True for a present charge that holds no number."""
    if isinstance(dtype, T.StringType):
        bare = _bare(value)
        return value.isNotNull() & _plain_number(bare).isNull() & (_leading_number(bare) == "")
    return value.isNotNull() & _number(value, dtype).isNull()


def _number(value: Column, dtype: T.DataType) -> Column:
    return F.when(~F.isnan(value), value) if isinstance(dtype, (T.FloatType, T.DoubleType)) else value

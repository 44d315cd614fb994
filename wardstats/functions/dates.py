"""Admission and discharge dates to exact milliseconds, and length of stay.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MS = 86_400_000

PLAIN_DATE = r"^\d{4}-\d\d-\d\d$"

# Accepted date texts (fixed values): YYYY-MM-DD, then optionally HH:MM[:SS[.fff]]
# and a zone. A day of 31 in a shorter month runs over into the next month, and
# so does hour 24 into the next day.
DATE_TEXT = (
    r"^\d{4}-\d{2}-(?:0[1-9]|[12]\d|3[01])[\sT]*"
    r"(?:(?:[01]\d|2[0-4]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
    r"\s*(?:[Zz]|[+-](?:0\d|1[0-4]):[0-5]\d)?\s*)?$"
)
BLANKS = " T\t\n\x0b\f\r"


def _date_millis(text: Column) -> Column:
    first_of_month = F.concat(F.substring(text, 1, 8), F.lit("01")).try_cast("date")
    day = F.substring(text, 9, 2).try_cast("int")
    return (F.unix_date(first_of_month) + day - 1).cast("bigint") * F.lit(DAY_MS)


def _clock_millis(text: Column) -> Column:
    clock = F.upper(F.translate(F.substring(text, 11, 2**31 - 1), BLANKS, ""))
    hour = F.substring(clock, 1, 2).try_cast("int")
    zone = F.when(clock.rlike("[Z+-]"), "").otherwise("Z")
    minute, rest = F.substring(clock, 3, 3), F.substring(clock, 6, 2**31 - 1)
    second = F.when(rest.startswith(":"), "").otherwise(":00")
    past_hour = F.concat(F.lit("1970-01-01T00"), minute, second, rest, zone)
    millis = hour * 3_600_000 + F.unix_millis(past_hour.try_cast("timestamp"))
    # Nothing but blanks after the date: midnight.
    return F.when(clock == "", F.lit(0)).otherwise(millis)


def epoch_millis(value: Column, dtype: T.DataType) -> Column:
    """Milliseconds since 1970-01-01; NULL for NULL or an unreadable text."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("bigint") * F.lit(DAY_MS)
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(value)
    if isinstance(dtype, T.TimestampNTZType):
        clock = (
            F.hour(value) * 3_600_000
            + F.minute(value) * 60_000
            + F.floor(F.date_part(F.lit("SECOND"), value) * 1000).cast("int")
        )
        return F.unix_date(value.cast("date")).cast("bigint") * F.lit(DAY_MS) + clock
    if isinstance(dtype, T.StringType):
        # Plain dates take the short way. Both ways together must stay below
        # the 8000 bytes of code up to which the JVM compiles a method.
        plain = F.when(value.rlike(PLAIN_DATE), F.unix_date(value.try_cast("date")))
        full = F.when(value.rlike(DATE_TEXT), _date_millis(value) + _clock_millis(value))
        return F.coalesce(plain.cast("bigint") * F.lit(DAY_MS), full)
    raise TypeError(f"not a date column type: {dtype.simpleString()}")


def los_millis(admit: Column, admit_type, discharge: Column, discharge_type) -> Column:
    """Length of stay, discharge minus admission, in whole milliseconds."""
    return epoch_millis(discharge, discharge_type) - epoch_millis(admit, admit_type)


def in_days(millis: Column) -> Column:
    """Milliseconds (BIGINT or DECIMAL) as DOUBLE days; whole days stay exact."""
    whole = F.call_function("div", millis, F.lit(DAY_MS))
    rest = millis % F.lit(DAY_MS)
    return whole.cast("double") + rest.cast("double") / F.lit(float(DAY_MS))

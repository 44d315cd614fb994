import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstats.functions import DAY_MS, epoch_millis, in_days, los_millis

TEXT = T.StringType()
HOUR = 3_600_000

# text -> milliseconds after 2024-01-01 00:00, or None if unreadable
TEXTS = {
    "2024-01-01": 0,
    "2024-01-02": DAY_MS,
    "2023-12-31": -DAY_MS,
    "2024-03-01": 60 * DAY_MS,
    "2024-01-01 ": 0,
    "2024-01-01T": 0,
    "2024-01-01 06:30": 6 * HOUR + 1_800_000,
    "2024-01-01T06:30:15": 6 * HOUR + 1_815_000,
    "2024-01-01 06:30:15.250": 6 * HOUR + 1_815_250,
    "2024-01-01T06:30:15.2501234567890123": 6 * HOUR + 1_815_250,
    "2024-01-0106:30": 6 * HOUR + 1_800_000,
    "2024-01-01\r\n": 0,
    "2024-01-01\t06:30\r": 6 * HOUR + 1_800_000,
    "2024-01-01  06:30": 6 * HOUR + 1_800_000,
    "2024-01-01 06:00Z": 6 * HOUR,
    "2024-01-01T06:00:00z": 6 * HOUR,
    "2024-01-01 06:00+02:00": 4 * HOUR,
    "2024-01-01 06:00:00.5 -05:30": 11 * HOUR + 1_800_500,
    "2024-01-01 24:00": DAY_MS,
    "2024-01-01 24:30:00": DAY_MS + 1_800_000,
    "2024-02-30": 60 * DAY_MS,
    "2023-02-29": 59 * DAY_MS - 365 * DAY_MS,
    "2024-04-31 12:00": 121 * DAY_MS + 12 * HOUR,
    "01/31/2024": None,
    "2024": None,
    "2024-1-5": None,
    "2024-01": None,
    "2024-13-01": None,
    "2024-00-01": None,
    "2024-01-00": None,
    "2024-01-32": None,
    "2024-01-01x": None,
    " 2024-01-01": None,
    "2024-01-01 25:00": None,
    "2024-01-01 6:30": None,
    "2024-01-01 06:60": None,
    "2024-01-01 06:30:60": None,
    "2024-01-01 06:30:15.": None,
    "2024-01-01 06:30+15:00": None,
    "2024-01-01 06:30 PST": None,
    "-2024-01-01": None,
    "١٢٣٤-01-01": None,
    "2024-01-5T": None,
    "": None,
    "now": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_date_text(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
        rows = df.select("t", epoch_millis(F.col("t"), TEXT).alias("ms")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    origin = 19_723 * DAY_MS
    for row in rows:
        want = TEXTS[row.t]
        assert row.ms == (None if want is None else origin + want), row.t


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "kind, days", [("timestamp_ntz", 1.5), ("date", 1.0), ("string", 1.5)]
)
def test_length_of_stay_ignores_clock_changes(spark, zone, kind, days):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10 00:00", "2024-03-11 12:00")], "a string, d string")
        df = df.select(F.col("a").cast(kind).alias("a"), F.col("d").cast(kind).alias("d"))
        kind = df.schema["a"].dataType
        los = in_days(los_millis(F.col("a"), kind, F.col("d"), kind))
        assert df.select(los.alias("los")).first().los == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_zero_negative_and_leap_stays(spark):
    df = spark.createDataFrame(
        [("2024-02-28", "2024-03-01"), ("2024-01-05", "2024-01-05"), ("2024-01-05", "2024-01-03")],
        "a string, d string",
    )
    los = in_days(los_millis(F.col("a"), TEXT, F.col("d"), TEXT))
    assert [r.los for r in df.select(los.alias("los")).collect()] == [2.0, 0.0, -2.0]


def test_typed_dates_give_whole_milliseconds(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 06:30:15.25' n, DATE'2024-01-01' d, "
                   "TIMESTAMP'2024-01-01 06:30:15.25Z' t")
    kinds = {f.name: f.dataType for f in df.schema}
    out = df.select([epoch_millis(F.col(c), kinds[c]).alias(c) for c in df.columns])
    assert {f.dataType.simpleString() for f in out.schema} == {"bigint"}
    origin, clock = 19_723 * DAY_MS, 6 * HOUR + 1_815_250
    assert tuple(out.first()) == (origin + clock, origin, origin + clock)


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        epoch_millis(F.col("x"), T.IntegerType())

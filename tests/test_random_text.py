"""Random charge and date texts against readers that go letter by letter."""

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstats.functions import DAY_MS, clean_currency, epoch_millis, is_bad_currency

TEXT = T.StringType()
HUGE = Decimal(10) ** 17
BLANK = " \t\n\r\f\v"


def leading_number(text):
    """(amount, found) of the longest number a text starts with."""
    text = text.replace("$", "").replace(",", "").lstrip(BLANK)
    at = 1 if text[:1] in ("+", "-") else 0

    def digits(start):
        end = start
        while end < len(text) and text[end] in "0123456789":
            end += 1
        return end

    whole = digits(at)
    end, count = whole, whole - at
    if text[whole:whole + 1] == ".":
        fraction = digits(whole + 1)
        count += fraction - whole - 1
        end = fraction
    if not count:
        return Decimal(0), False
    if text[end:end + 1] in ("e", "E"):
        sign = end + 1 + (text[end + 1:end + 2] in ("+", "-") and end + 1 < len(text))
        last = digits(sign)
        end = last if last > sign else end
    value = Decimal(text[:end])
    if value.adjusted() > 16:
        return HUGE, True
    return value.quantize(Decimal("1e-10"), ROUND_HALF_UP), True


def test_random_charges(spark):
    pick = random.Random(11)
    pieces = ["1", "7", "0", "25", "1,234", ".", ".5", "$", ",", "-", "+", " ", "e", "E", "e2", "x", "f", "d", "\t"]
    texts = {"".join(pick.choice(pieces) for _ in range(pick.randint(0, 7))) for _ in range(6000)}
    want = {t: leading_number(t) for t in texts}
    texts = [t for t in texts if want[t][0] != HUGE]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t", clean_currency(F.col("t"), TEXT).alias("v"), is_bad_currency(F.col("t"), TEXT).alias("bad")
    ).collect()
    wrong = [(r.t, r.v, r.bad) for r in rows if (r.v, not r.bad) != want[r.t]]
    assert not wrong, wrong[:10]
    assert len(rows) > 3000


def millis(text):
    """Milliseconds since 1970 of a date text, or None."""

    def number(at, size, low, high):
        part = text[at:at + size]
        if len(part) != size or any(c not in "0123456789" for c in part):
            return None
        return int(part) if low <= int(part) <= high else None

    def skip(at, letters):
        while at < len(text) and text[at] in letters:
            at += 1
        return at

    year, month, day = number(0, 4, 0, 9999), number(5, 2, 1, 12), number(8, 2, 1, 31)
    if None in (year, month, day) or text[4] != "-" or text[7] != "-" or year == 0:
        return None
    total = ((date(year, month, 1) - date(1970, 1, 1)).days + day - 1) * DAY_MS
    at = skip(10, BLANK + "T")
    if at == len(text):
        return total
    hour, minute = number(at, 2, 0, 24), number(at + 3, 2, 0, 59)
    if hour is None or minute is None or text[at + 2] != ":":
        return None
    total += (hour * 60 + minute) * 60_000
    at += 5
    if text[at:at + 1] == ":":
        second = number(at + 1, 2, 0, 59)
        if second is None:
            return None
        total += second * 1000
        at += 3
        if text[at:at + 1] == "." and text[at + 1:at + 2].isdigit():
            end = skip(at + 1, "0123456789")
            total += int(text[at + 1:end].ljust(3, "0")[:3])
            at = end
    at = skip(at, BLANK)
    if text[at:at + 1] in ("Z", "z"):
        at += 1
    elif text[at:at + 1] in ("+", "-"):
        hours, minutes = number(at + 1, 2, 0, 14), number(at + 4, 2, 0, 59)
        if hours is None or minutes is None or text[at + 3] != ":":
            return None
        total -= (1 if text[at] == "+" else -1) * (hours * 60 + minutes) * 60_000
        at += 6
    return total if skip(at, BLANK) == len(text) else None


def test_random_dates(spark):
    pick = random.Random(12)

    def text():
        day = date(1900, 1, 1) + timedelta(days=pick.randrange(80_000))
        out = f"{day:%Y-%m-}{pick.choice([day.day, 29, 30, 31]):02d}"
        if pick.random() < 0.7:
            out += pick.choice([" ", "T", "  ", "", " T"])
            out += f"{pick.randrange(26):02d}:{pick.randrange(61):02d}"
            if pick.random() < 0.6:
                out += f":{pick.randrange(61):02d}" + pick.choice(["", "", ".5", ".125", ".", ".0004"])
            out += pick.choice(["", "", "", "Z", "z", " Z", "+05:30", "-14:00", "+15:00", " -03:15", "+5"])
        out += pick.choice(["", "", "", " ", "\r", "x"])
        if pick.random() < 0.2:
            at = pick.randrange(len(out))
            out = out[:at] + pick.choice(["", "-", "7", " ", "T", ":", "a"]) + out[at + 1:]
        return out

    texts = list({text() for _ in range(8000)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", epoch_millis(F.col("t"), TEXT).alias("ms")).collect()
    wrong = [(r.t, r.ms, millis(r.t)) for r in rows if r.ms != millis(r.t)]
    assert not wrong, (len(wrong), wrong[:10])
    assert sum(r.ms is not None for r in rows) > 3000

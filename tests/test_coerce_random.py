"""Random text cells against the parsing rules of Python's own constructors."""

import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import coerce as C

UTC = timezone.utc


def integer(text):
    text = text.strip()
    try:
        value = int(text)
    except ValueError:
        number = float(text)
        if not number.is_integer():
            raise ValueError(text) from None
        value = int(number)
    if not -2 ** 63 <= value < 2 ** 63:
        raise ValueError(text)
    return value


def timestamp(text):
    text = text.strip()
    if text.removeprefix("-").isdigit() or (text.count(".") == 1 and text.replace(".", "").lstrip("+-").isdigit()
                                            and text[-1] != "." and text.lstrip("+-")[0] != "."
                                            and len(text) - len(text.lstrip("+-")) < 2):
        return micros(datetime.fromtimestamp(float(text), UTC))
    value = datetime.fromisoformat(text)
    return micros(value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC))


def day(text):
    text = text.strip()
    if text.isdigit() and len(text) == 10:  # read as eight digits by some versions, the rest ignored
        raise ValueError(text)
    return date.fromisoformat(text)


def micros(value):
    gap = value - datetime(1970, 1, 1, tzinfo=UTC)
    return (gap.days * 86400 + gap.seconds) * 1000000 + gap.microseconds


def numbers(rng):
    pick = lambda *xs: rng.choice(xs)
    digits = lambda: "".join(rng.choice("0123456789") for _ in range(rng.choice([1, 1, 2, 5, 15, 16, 18, 19, 20])))
    body = pick(digits(), digits() + "." + digits(), digits() + ".", "." + digits(), digits() + "." + "0" * rng.randint(1, 4),
                digits()[:4] + "e" + pick("", "+", "-") + digits()[:2], digits() + "_" + digits(), "_" + digits(),
                digits() + "__1", pick("nan", "inf", "Infinity", "INF", "infinit", "abc", "", "0x1", "1d", "1f", "1L", "--1")
                , digits() + "." + digits() + pick("e5", "E2", "e"), "1_0.0_1e1_0")
    return pick("", " ", "\t", "\n", " ") + pick("", "", "", "-", "+") + body + pick("", "", " ", "\r\n")


def times(rng):
    pick = lambda *xs: rng.choice(xs)
    two = lambda top: f"{rng.randint(0, top):02d}"
    day = pick(f"20{two(40)}-{two(13)}-{two(32)}", f"20{two(40)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
               f"20{two(40)}{rng.randint(1, 12):02d}{rng.randint(1, 28):02d}", "2024-1-5", "0001-01-01", "9999-12-31", "24-01-05")
    clock = pick(two(24), f"{two(24)}:{two(60)}", f"{two(23)}:{two(59)}:{two(59)}", f"{two(23)}{two(59)}{two(59)}", f"{two(23)}{two(59)}",
                 f"{two(23)}:{two(59)}:{two(59)}{pick('.', ',')}{rng.randint(0, 10 ** rng.randint(1, 9) - 1)}",
                 f"{two(23)}:{two(59)}:{two(59)}.{rng.randint(0, 999999):06d}", "12:3", "1:30")
    zone = pick("", "", "Z", "+02:00", "-05:30", "+0200", "-05", "+14:00", "z", "UTC", "+2:00", "+25:00")
    whole = day + pick("T", " ", "T", "t", "_") + clock + zone
    epoch = pick("", "-", "+") + pick(str(rng.randint(0, 3 * 10 ** 9)), f"{rng.randint(0, 2 * 10 ** 9)}.{rng.randint(0, 9999999)}",
                                      "253402300799", "253402300800", "99999999999999", "12:30", "hello", "")
    return pick("", " ") + pick(whole, whole, whole, day, epoch) + pick("", " ")


CASES = {
    "INTEGER": (numbers, integer, T.LongType()),
    "FLOAT": (numbers, lambda t: float(t.strip()), T.DoubleType()),
    "TIMESTAMP": (times, timestamp, T.TimestampType()),
    "DATE": (times, day, T.DateType()),
}


@pytest.mark.parametrize("target", CASES)
def test_against_python(spark, target):
    make, parse, _ = CASES[target]
    rng = random.Random(11)
    cells = sorted({make(rng) for _ in range(4000)} - {""})
    df = spark.createDataFrame([(c,) for c in cells], "x string")
    value = C.coerced(F.col("x"), T.StringType(), target)
    if target == "TIMESTAMP":  # as microseconds: Python cannot take the first day of year 1 back as a timestamp
        value = F.unix_micros(value)
    rows = df.select("x", value.alias("v")).collect()
    wrong = []
    for x, got in rows:
        try:
            want = parse(x)
        except (ValueError, OverflowError, OSError):
            want = None
        same = got == want or (got is not None and want is not None and got != got and want != want)
        if not same:
            wrong.append((x, want, got))
    assert not wrong, (len(wrong), len(rows), wrong[:12])

"""Scalar rules used while shaping records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import coerce as C

# Fixed value: the pattern of an hour range such as "13:00:00 - 13:59:59".
HOUR_RANGE = r"^\s*(\d{1,2}):\d{2}:\d{2}\s*-\s*\d{1,2}:\d{2}:\d{2}\s*$"

# What a redacted secret becomes, and the shortest text worth masking.
REDACTED = "***"
SHORTEST_SECRET = 4


def instant(df: DataFrame, value: Column) -> Column:
    """A timestamp aggregate over ``df`` as text that names its zone (the session's, UTC): a
    timestamp that Python fetches has no zone and is in the driver's.  Other types stay."""
    kind = df.select(value.alias("v")).schema["v"].dataType.typeName()
    if not kind.startswith("timestamp"):
        return value
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def hour_of_range(text: Column) -> Column:
    """First hour of an hour range; NULL unless it is 0..23."""
    hour = F.regexp_extract(text, HOUR_RANGE, 1).try_cast("bigint")
    return F.when(hour.between(0, 23), hour)


def hour_of_int(value: Column) -> Column:
    return F.when(value.between(0, 23), value.cast("bigint"))


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def seconds_to_date(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("bigint")).cast("date")


def lenient_float(text: Column) -> Column:
    """A float, or NULL for anything that is not one."""
    return C.double_of_text(C.trimmed(text))


def lenient_int(text: Column) -> Column:
    """A float cut to its whole part, or NULL; unlike normalize, 1.9 gives 1."""
    return lenient_float(text).try_cast("bigint")


def period_value(text: Column, period: str) -> Column:
    """A metric given either as a number or as ``{period: number}``."""
    keyed = F.get_json_object(text, f"$['{period}']")
    is_object = F.ltrim(text).startswith("{")
    return lenient_float(F.when(is_object, keyed).otherwise(text))


def key_text(value: Column, source: T.DataType = T.StringType()) -> Column:
    """Text for a merge-key column: ``''`` instead of NULL, so that equal keys match."""
    return F.coalesce(C.to_text(value, source), F.lit(""))


def cursor_to_utc(text: Column) -> Column:
    """Cursor text to a UTC timestamp; without an offset it already is UTC."""
    return C.timestamp_of_iso(text)


def first_ten_to_date(value: Column) -> Column:
    """Date from the first ten characters of a value's text."""
    return C.coerced(F.substring(value.cast("string"), 1, 10), T.StringType(), "DATE")


def sql_timestamp_text(text: Column) -> Column:
    """Cursor text as ``YYYY-MM-DD HH:MM:SS``: no T, no zone, no fraction."""
    bare = F.regexp_replace(C.trimmed(text), r"(?:Z$|[+-].{2}:.{2}$)", "")
    return F.substring_index(F.replace(bare, F.lit("T"), F.lit(" ")), ".", 1)


def iso_text(value: Column, source: T.DataType) -> Column:
    """Cursor value as it is sent to a remote API: ISO-8601 for times, else plain text."""
    if isinstance(source, T.TimestampType):
        return F.replace(C.to_text(value, source), F.lit(" "), F.lit("T"))
    return C.to_text(value, source)


def redact(text: Column, secrets: Sequence[str]) -> Column:
    """Mask every secret; values too short to be one are left alone.

    Secrets are masked in the order given, each everywhere it occurs.
    """
    for secret in dict.fromkeys(secrets):
        if len(secret) >= SHORTEST_SECRET:
            text = F.replace(text, F.lit(secret), F.lit(REDACTED))
    return text

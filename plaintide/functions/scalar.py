"""Scalar column functions whose results do not depend on session settings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round2(x: Column) -> Column:
    """Two decimals by scale, round, unscale; `round(x, 2)` goes through decimal text and differs on ties."""
    return F.round(x * F.lit(100.0), 0) / F.lit(100.0)


def percent(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole` as DOUBLE, two decimals, NULL if `whole` is 0."""
    return round2(F.lit(100.0) * part / F.nullif(whole, F.lit(0).cast("long")))


def share_percent(part: Column, whole: Column) -> Column:
    """As :func:`percent`, dividing before scaling; the last bit can differ, which moves a rounding tie."""
    return round2(part / F.nullif(whole, F.lit(0).cast("long")) * F.lit(100.0))


def flag(condition: Column) -> Column:
    """1, 0 or NULL. Its sum counts the true rows and is NULL if no row has a value."""
    return condition.cast("long")


def typed_null(data_type: T.DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def utc_wall(ts: Column) -> Column:
    """UTC wall-clock time of an instant as TIMESTAMP_NTZ, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast("timestamp_ntz"))


def from_utc_wall(wall: Column) -> Column:
    """Inverse of :func:`utc_wall`: the instant at which UTC clocks show a zone-less time."""
    since = wall.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = since.cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((seconds * F.lit(1_000_000)).cast("long"))


def utc_date_sql(df: DataFrame, name: str) -> str:
    """UTC day of a timestamp column as SQL; a zone-less timestamp or a date is taken as it is."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return f"CAST(timestampadd(MICROSECOND, unix_micros({name}), TIMESTAMP_NTZ '1970-01-01') AS DATE)"
    return f"CAST({name} AS DATE)"


def day_start(df: DataFrame, name: str, day: date) -> Column:
    """The begin of a UTC day as a constant of the column's type, so that a comparison reaches the scan."""
    kind = df.schema[name].dataType
    text = f"{day.isoformat()}T00:00:00Z" if isinstance(kind, T.TimestampType) else day.isoformat()
    return F.lit(text).cast(kind)


def utc_text(wall: Column) -> Column:
    """ISO-8601 text with milliseconds and `Z` for a UTC wall-clock TIMESTAMP_NTZ."""
    text = wall.cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis, F.lit("Z"))


def strict_cast(column: Column, data_type: T.DataType, name: str) -> Column:
    """Cast that fails the query on a bad value, also in sessions that switched ANSI mode off."""
    tried = column.try_cast(data_type)
    message = F.concat(F.lit(f"{name}: cannot cast to {data_type.simpleString()}: "), column.cast("string"))
    return F.when(column.isNotNull() & tried.isNull(), F.raise_error(message).cast(data_type)).otherwise(tried)


def instant(text: Column) -> Column:
    """Timestamp text with an explicit zone: text that names none is UTC."""
    zoned = text.rlike(r"[T ]\d.*[+-]\d\d(:?\d\d)?$")
    timed = text.rlike(r"[T ]\d")
    return F.when(text.endswith("Z"), text).when(zoned, text).when(timed, F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))


def count_text(n: Column) -> Column:
    """`1234567` as `1,234,567`, NULL as `-`."""
    return F.coalesce(F.format_number(n, 0), F.lit("-"))


def percent_text(x: Column) -> Column:
    """Non-negative percent with one decimal, NULL as `-`.

    The digit is rounded on the exact binary value (half to even), as C and Python do. Java's `%.1f`
    rounds the shortest decimal text instead and gives another digit for many `x.x5`. The fraction times
    2^58 is exact in a BIGINT, so is ten times that.
    """
    whole = F.floor(x)
    scaled = ((x - whole) * F.lit(float(2**58))).cast("long") * F.lit(10)
    digit = F.shiftright(scaled, 58)
    rest = scaled.bitwiseAND(F.lit(2**58 - 1))
    up = (rest > F.lit(2**57)) | ((rest == F.lit(2**57)) & (digit % 2 == 1))
    tenths = whole * 10 + digit + F.when(up, 1).otherwise(0)
    text = F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))
    return F.coalesce(text, F.lit("-"))

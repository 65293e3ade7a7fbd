"""Small column expressions used across the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_millis(df: DataFrame, column: str) -> Column:
    """Truncate a timestamp to milliseconds without changing its type."""
    cut = F.date_trunc("millisecond", F.col(column))
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return cut.cast("timestamp_ntz")
    return cut


def hours_since(df: DataFrame, column: str, origin: str) -> Column:
    """Hours between ``origin`` and a timestamp column, as a double.

    A zone-less timestamp is measured on its own calendar fields, so the result
    does not depend on the session time zone.
    """
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        days = F.date_diff(F.to_date(c), F.lit(origin[:10]).cast("date"))
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)
        hours = days * F.lit(24.0) + seconds.cast("double") / F.lit(3600.0)
        if origin[10:].strip(" 0:"):
            raise ValueError("a zone-less series needs an origin at midnight")
        return hours
    start = F.lit(origin).cast("timestamp")
    return (F.unix_micros(c) - F.unix_micros(start)).cast("double") / F.lit(3.6e9)


def extract_or_null(column: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group; NULL (not an empty string) where nothing matches."""
    found = F.regexp_extract(column, pattern, group)
    return F.coalesce(F.nullif(found, F.lit("")), F.when(column.rlike(pattern), F.lit("")))


def round_half_up(column: Column, digits: int) -> Column:
    """Round half up on decimal digits, the same for every order of summation.

    A mean of two-decimal readings is often half a unit of the last digit, give or
    take floating-point noise; cutting at the ninth digit first removes the noise.
    """
    return F.round(F.round(column, 9), digits)


def minus_seconds(column: Column, seconds: int) -> Column:
    return column - F.expr(f"INTERVAL '{int(seconds)}' SECOND")


def json_text(*columns: Column) -> Column:
    """A JSON object of the named columns; NULL fields are kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def direction_label(value: Column, upper: Column, lower: Column) -> Column:
    return F.when(value > upper, "HIGH").when(value < lower, "LOW").otherwise("OUTLIER")

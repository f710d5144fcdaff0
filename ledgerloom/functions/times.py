"""Event-time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed pattern: ISO-8601 date, optional time with fraction, optional offset.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?\z"


def iso_instant(text: Column) -> Column:
    """Parse ISO-8601 text; text without an offset is taken as UTC, anything else is NULL."""
    seconds = F.when(F.substring(text, 17, 1) == ":", text).otherwise(
        F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 6))
    )
    has_offset = (F.substring(text, -1, 1) == "Z") | F.substring(text, -6, 1).isin("+", "-")
    zoned = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(has_offset, seconds)
        .otherwise(F.concat(seconds, F.lit("Z")))
    )
    return F.when(text.rlike(ISO_PATTERN), F.try_to_timestamp(zoned))


def micros_of(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch of a timestamp column, with or without zone."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        # Field by field, since casting or subtracting would go through the session zone.
        ts = F.col(column)
        minutes = (F.unix_date(ts.cast("date")) * 24 + F.hour(ts)).cast("long") * 60 + F.minute(ts)
        return minutes * 60_000_000 + (F.date_part(F.lit("SECONDS"), ts) * 1_000_000).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(column))
    raise TypeError(f"{column} must be a timestamp column, not {dtype.simpleString()}")

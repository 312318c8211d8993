"""Timestamp helpers that keep the results of non-ANSI casts under Spark 4's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a session-zone TIMESTAMP; unparsable text becomes NULL instead of raising."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col)
    return col.try_cast("timestamp")


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP (floors sub-seconds, like ``cast(ts as long)``)."""
    return ts.cast("long")


def duration_minutes(start: Column, end: Column) -> Column:
    """(epoch_s(end) - epoch_s(start)) / 60.0 as DOUBLE."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def stamp(now: Column | str | None) -> Column:
    """The run clock: a fixed literal for reproducible runs, else ``current_timestamp()``."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, str):
        return F.lit(now).cast("timestamp")
    return now

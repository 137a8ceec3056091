"""Date and time functions.  Text without an offset is UTC, whatever zone the session has."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form that :func:`iso_utc` gives, and a date alone.
ISO_UTC = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"
ISO_DATE = r"^\d{4}-\d\d-\d\d$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_or_null(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Date-like text to timestamp, value by value: ISO text (a date, or a date and
    time with or without offset) first, then each of ``formats`` in order."""
    text = F.trim(_col(c).cast("string"))
    in_utc = (F.when(text.rlike(r"^\d{4,6}$"), F.concat(text, F.lit("-01-01T00:00:00Z")))
              .when(text.rlike(r"^\d{4,6}-\d{1,2}$"), F.concat(text, F.lit("-01T00:00:00Z")))
              .when(text.rlike(r"^\d{4,6}-\d{1,2}-\d{1,2}[T ]?$"),
                    F.concat(F.rtrim(F.regexp_replace(text, "T$", "")), F.lit("T00:00:00Z")))
              .when(text.rlike(r"^\d{4,6}-\d{1,2}-\d{1,2}[T ]\d{1,2}(:\d{1,2}){0,2}(\.\d*)?$"),
                    F.concat(text, F.lit("Z")))
              .otherwise(text))
    # a pattern's fields are read in the session's zone; taken as they stand, they are UTC
    others = [F.concat(F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz").cast("string"), F.lit("Z"))
              .try_cast("timestamp") for f in formats]
    return F.coalesce(in_utc.try_cast("timestamp"), *others)


def iso_utc(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Date-like text to ISO-8601 UTC text; unreadable values become null.  Text that has this form already,
    and a date, are only checked."""
    text = _col(c).cast("string")
    whole = F.concat(text, F.lit("T00:00:00Z"))
    return (F.when(text.rlike(ISO_UTC) & text.try_cast("timestamp").isNotNull(), text)
            .when(text.rlike(ISO_DATE) & whole.try_cast("timestamp").isNotNull(), whole)
            .otherwise(_spelled_utc(c, formats)))


def _spelled_utc(c: Column | str, formats: Sequence[str]) -> Column:
    """The moment that a text of any form names, spelled out."""
    seconds = F.unix_seconds(timestamp_or_null(c, formats))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = (epoch + F.make_dt_interval(F.floor(seconds / F.lit(86400)).cast("int"), F.lit(0), F.lit(0),
                                         F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))).cast("string")
    return F.concat(F.regexp_replace(moment, " ", "T"), F.lit("Z"))


def days_since(ts: Column | str, as_of: datetime | str | Column) -> Column:
    """Whole days from ``ts`` to ``as_of``, never negative; null stays null."""
    if isinstance(as_of, datetime):
        as_of = F.lit(int((as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)).timestamp())).cast("timestamp")
    moment = as_of.cast("timestamp") if isinstance(as_of, Column) else timestamp_or_null(F.lit(as_of))
    elapsed = F.unix_timestamp(moment) - F.unix_timestamp(_col(ts))
    days = F.floor(elapsed / F.lit(86400)).cast("bigint")
    return F.when(days < 0, F.lit(0).cast("bigint")).otherwise(days)

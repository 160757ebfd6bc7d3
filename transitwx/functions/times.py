"""Parsing, formatting and splitting of times (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the timetable and of the file names.
STOP_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"
STOP_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}Z$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
MONTH_IN_NAME = r"(\d{4})_(\d{2})"


def micros(time: Column) -> Column:
    """Microseconds since the epoch; the numeric key of all time windows."""
    return F.unix_micros(time.cast("timestamp"))


def time_block(us: Column, width: int) -> Column:
    """Number of the time block ``us`` lies in, exact for any long."""
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")


def parse_stop_time(text: Column) -> Column:
    """Stop time with its mandatory fraction; NULL when it does not fit.

    The shape is tested first: a cast reads much faster than a format, and bad
    text costs no exception.
    """
    return F.when(text.rlike(STOP_TIME_SHAPE), text).try_cast("timestamp")


def parse_lenient(text: Column) -> Column:
    """Any timestamp text Spark knows; NULL instead of an error."""
    return F.try_to_timestamp(text)


def parse_date(text: Column) -> Column:
    """``YYYY-MM-DD`` only; NULL instead of an error."""
    return F.when(text.rlike(DATE_SHAPE), text).try_cast("date")


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def month_start(day: Column) -> Column:
    """First day of the month, the key that pairs trains with weather."""
    return F.trunc(day, "month")


def month_from_name(name: Column) -> Column:
    """``YYYY-MM`` out of a file name that holds ``YYYY_MM``; NULL if none."""
    year = F.regexp_extract(name, MONTH_IN_NAME, 1)
    month = F.regexp_extract(name, MONTH_IN_NAME, 2)
    return F.when(year != "", F.concat_ws("-", year, month))


def monthly_name(base: Column | str, day: Column) -> Column:
    """``base_YYYY_MM.csv``; a ``.csv`` at the end of the base is dropped."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(
        F.regexp_replace(base, r"\.csv$", ""),
        F.lit("_"),
        F.date_format(day, "yyyy_MM"),
        F.lit(".csv"),
    )


def days_between(start: Column, end: Column) -> Column:
    """Array of all days of a closed range."""
    return F.sequence(start, end, F.expr("interval 1 day"))


def chunks(start: Column, end: Column, hours: int = 1) -> Column:
    """Array of (chunk_start, chunk_end); the last chunk stops at ``end``."""
    step = F.expr(f"interval {int(hours)} hours")
    starts = F.filter(F.sequence(start, end, step), lambda s: s < end)
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("chunk_start"), F.least(s + step, end).alias("chunk_end")),
    )

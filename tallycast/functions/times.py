"""Column expressions over zone-less timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event time pattern, as Spark pattern and as the shape a text must have.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

MINUTES_PER_DAY = 1440


def parse_time(text: Column) -> Column:
    """Text in ``TIME_FORMAT`` to timestamp_ntz; anything else, a header word included, to null.

    Independent of the session zone, and never throws in ANSI mode.
    """
    return F.when(text.rlike(TIME_SHAPE), text.try_cast("timestamp_ntz"))


def epoch_minute(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00, as bigint."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * MINUTES_PER_DAY + F.hour(ts) * 60 + F.minute(ts)


def minute_start(minute: Column) -> Column:
    """Inverse of ``epoch_minute``: the timestamp_ntz at which the minute starts."""
    day = F.floor(minute / F.lit(MINUTES_PER_DAY)).cast("int")
    rest = F.pmod(minute, F.lit(MINUTES_PER_DAY)).cast("int")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(day, zero, rest, zero)


def slot_clock(hour: Column, minute: Column) -> Column:
    """Time of day as ``HH:mm:00`` text."""
    return F.format_string("%02d:%02d:00", hour, minute)


def slot_on_day(hour: Column, minute: Column, day: str = "2024-01-01") -> Column:
    """Time of day as timestamp_ntz on a fixed anchor day."""
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hour.cast("int"), minute.cast("int"), F.lit(0)
    )

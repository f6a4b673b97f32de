"""Parts of a ``timestamp_ntz``, read without going through the session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(hour: Column) -> Column:
    """An hour number as text, '00' to '23'."""
    return F.lpad(hour.cast("string"), 2, "0")


def epoch_second(time: Column) -> Column:
    """Whole seconds since 1970-01-01, rounded down."""
    day = F.unix_date(time.cast("date")).cast("bigint")
    return day * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def micro_of_second(time: Column) -> Column:
    """Microseconds past the whole second, 0 to 999999."""
    return (F.date_part(F.lit("SECOND"), time) * 1000000).cast("bigint") % 1000000

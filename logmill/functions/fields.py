"""Text fields of a log line to typed values.

Each function returns null where the text does not convert; ``operators.clean``
decides whether that fails the job or sends the line to the rejects. None of
them depends on ANSI mode or on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations of the log format.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# day/month/year:hour:minute:second, then a blank and the zone offset.
_STAMP = (
    r"(?U)^(?: (?=[1-9]/))?([0-9]{1,2})/([A-Za-z]{3})/((?!0000)[0-9]{4})"
    r":([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})[\s\x1c-\x1f]+"
)
_STAMPS = {
    "reference": (_STAMP + r"[+]([0-9]{1,6})\z", ".$7"),
    "utc": (_STAMP + r"([+-])(0[0-9]|1[0-8])([0-5][0-9])\z", "\n$7\n$8\n$9"),
}


def to_bytes(text: Column) -> Column:
    """Response size; ``-`` means nothing was sent."""
    return F.when(text == "-", F.lit(0).cast("bigint")).otherwise(text.try_cast("bigint"))


def to_status(text: Column) -> Column:
    return text.try_cast("bigint")


def stamp_parts(text: Column, offset_mode: str = "reference") -> Column:
    """Request time taken apart in one pattern match: year, month name, the rest in
    ISO order, and in ``utc`` mode the offset's sign, hours and minutes.

    Text that does not match stays whole, as the only part. Keep the result in a
    column of its own before using it, or the pattern runs once per use.
    """
    pattern, rest = _STAMPS[_known(offset_mode)]
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit("$3\n$2\n$1 $4:$5:$6" + rest)), "\n", -1)


def to_datetime(text: Column, parts: Column, offset_mode: str = "reference") -> Column:
    """Request time as ``timestamp_ntz``, from the text and its parts; empty text is 1900-01-01.

    ``reference`` keeps the wall-clock time and reads the digits after ``+`` as a
    fraction of a second (``+0330`` adds 33 ms); a negative offset does not
    convert. ``utc`` applies the offset instead.
    """
    year, month, rest, sign, hours, minutes = (F.get(parts, F.lit(n)) for n in range(6))
    numbers = F.create_map(*[F.lit(v) for n, m in enumerate(MONTHS, 1) for v in (m, str(n))])
    number = F.try_element_at(numbers, F.lower(month))
    stamp = F.concat(year, F.lit("-"), number, F.lit("-"), rest).try_cast("timestamp_ntz")
    if _known(offset_mode) == "utc":
        offset = F.make_dt_interval(hours=hours.try_cast("int"), mins=minutes.try_cast("int"))
        stamp = F.when(sign == "-", stamp + offset).otherwise(stamp - offset)
    start = F.lit("1900-01-01").cast("timestamp_ntz")
    return F.when(text == "", start).otherwise(stamp)


def _known(offset_mode: str) -> str:
    if offset_mode not in _STAMPS:
        raise ValueError(f"offset_mode must be one of {sorted(_STAMPS)}, not {offset_mode!r}")
    return offset_mode

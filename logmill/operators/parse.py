"""Log lines to fields.

The line pattern runs once per line: one ``regexp_replace`` writes all groups
with a line feed between them and ``split`` takes them apart. A line feed cannot
be inside a group, because the text source cuts lines there and no part of the
pattern accepts one. The result goes through ``explode`` of a one-element array
so that a later filter on a field cannot be pushed below it and run the pattern
a second time.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmill.schema import FIELDS

# The log line format. Blank means Unicode blank or one of the four
# separator control characters; only the line feed ends a line. The pattern
# is tied to the start of the line and lets any text follow the last field.
_WORD = r"([^\s\x1c-\x1f]++)"
_LAST_WORD = r"([^\s\x1c-\x1f]+)"
LINE_PATTERN = (
    rf'(?dU)^{_WORD} {_WORD} {_WORD} \[(.*?)\] "{_WORD} {_WORD} {_LAST_WORD}" '
    rf'{_WORD} {_WORD} "(.*?)" "([^"\n]*+)"'
)

# The second branch takes the whole of any other line and leaves every group empty.
_WHOLE_LINE = LINE_PATTERN + r"(?s:.*)|^(?s:.*)"
_GROUPS = "\n".join(f"${n}" for n in range(1, len(FIELDS) + 1))


def split_lines(lines: DataFrame) -> DataFrame:
    """``value`` plus the eleven text fields, all null where the line does not match."""
    groups = F.split(F.regexp_replace("value", F.lit(_WHOLE_LINE), F.lit(_GROUPS)), "\n", -1)
    matched = F.col("groups")[0] != ""  # the host is never empty in a match
    return lines.select("value", F.explode(F.array(groups)).alias("groups")).select(
        "value", *[F.when(matched, F.col("groups")[n]).alias(f) for n, f in enumerate(FIELDS)]
    )


def parse(lines: DataFrame) -> DataFrame:
    """The eleven text fields of the lines that match."""
    return split_lines(lines).filter(F.col("host").isNotNull()).select(*FIELDS)


def is_log_line(value: Column) -> Column:
    return value.rlike(LINE_PATTERN)


def rejects(lines: DataFrame) -> DataFrame:
    """The lines that do not match, unchanged."""
    return lines.filter(~is_log_line(F.col("value"))).select("value")

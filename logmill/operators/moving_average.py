"""Moving average over a time range, without a global window.

``AVG(v) OVER (ORDER BY t RANGE BETWEEN h PRECEDING AND h FOLLOWING)`` written as
a Spark window puts the whole table into one partition and adds up every frame
from scratch. Here the table is first reduced to its distinct times, with
map-side combine, so that a hot time is no problem. Every frame is then the sum
of two, each a difference of running sums:

* Whole seconds. The frame of a time in second s covers all of the seconds
  between s - h and s + h. Times are summed per second, seconds are cut into
  buckets of ``12 h``, and those within ``h`` of a border are copied to the next
  bucket too, 17% more rows.
* Both ends. In second s - h the frame starts at the time's own offset into the
  second, in s + h it ends there. Among the seconds that have the remainder of
  s by ``h``, put one after the other, the frame is one second to each side:
  again a range, in buckets of 12 such seconds.

A window group thus holds ``14 h`` seconds or 14 seconds of distinct microseconds
at most, whatever the size of the table: there is one way for all of them.

All sums are of integers: exact, and the same in any order of adding.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logmill.functions import epoch_second, hour_of_day, join_limbs, limbs, micro_of_second
from logmill.functions.scratch import materialize

_SUMS = ("high", "low", "n")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

_SECOND = 1_000_000

# A time with many records is written out in pieces: so many at most, unless that
# makes them larger than this.
_MOST_PIECES = 1 << 22
_LARGEST_PIECE = 1 << 18
_ROWS_PER_TASK = 4_000_000
_MAX_TASKS = 100_000


def range_moving_avg(
    df: DataFrame, time: str, value: str, half_width_seconds: int, alias: str = "moving_avg"
) -> DataFrame:
    """One row per distinct time: ``time``, the average as ``alias``, and ``records``,
    the number of input rows at that time.

    ``time`` is a ``timestamp_ntz`` and ``value`` an integer column. Rows without
    a time are each other's frame, as in SQL. Runs one job right away, which
    writes the distinct times to the shared scratch folder.
    """
    return _averages(_distinct_times(df, time, value), half_width_seconds).select(
        F.col("time").alias(time), F.col("average").alias(alias), "records"
    )


def moving_avg_per_record(df: DataFrame, half_width_seconds: int = 7200) -> DataFrame:
    """Hour of day and moving average of ``bytes``, one row per log record, ordered by both.

    Both columns follow from the time alone, so the records are not joined back:
    the few distinct times are sorted and then written out once per record.
    Before the sort, times with more records than the mean are cut into pieces of
    about that size. That at most doubles the rows to sort, and the ranges then
    hold about equal shares of the output even where one time has a third of it.
    """
    alias = "bytes_5_hours_mov_avg"
    # Stored, because the range partitioning below reads its input twice.
    averages, count = materialize(
        _averages(_distinct_times(df, "datetime", "bytes"), half_width_seconds),
        "averages",
        F.count(F.lit(1)).alias("times"),
        F.sum("records").alias("records"),
        F.max("records").alias("most"),
    )
    times, records, most = (count[c] or 1 for c in ("times", "records", "most"))
    piece = min(max(ceil(records / times), ceil(most / _MOST_PIECES)), _LARGEST_PIECE)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(cores, records // _ROWS_PER_TASK), _MAX_TASKS)
    pieces = averages.select(
        hour_of_day(F.hour("time")).alias("dt"),
        F.col("average").alias(alias),
        "time",
        "records",
        F.expr(f"explode(sequence(0L, (records - 1) div {piece}))").alias("piece"),
    )
    ordered = [F.col(c).asc_nulls_last() for c in ("dt", alias, "time", "piece")]
    copies = F.least(F.col("records") - F.col("piece") * piece, F.lit(piece))
    return (
        # A fixed number of ranges: AQE would merge them by their size before the rows are written out.
        pieces.repartitionByRange(tasks, *ordered)
        .sortWithinPartitions(*ordered)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(True), copies.cast("int"))))
        .select("dt", alias)
    )


def _distinct_times(df: DataFrame, time: str, value: str) -> DataFrame:
    """Record count, value count and value sum per time, stored in the scratch folder."""
    if not isinstance(df.schema[value].dataType, _INTEGERS):
        raise TypeError(f"{value} must be an integer column")
    high, low = limbs(F.col(value).cast("bigint"))
    none = F.lit(0).cast("bigint")
    times = df.groupBy(F.col(time).alias("time")).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(high), none).alias("high"),
        F.coalesce(F.sum(low), none).alias("low"),
        F.count(value).alias("n"),
    )
    return materialize(times, "distinct-times")[0]


def _averages(times: DataFrame, half_width: int) -> DataFrame:
    """``time``, ``average`` and ``records`` for each of the stored times."""
    if half_width < 1:
        raise ValueError("the half width must be at least one second")
    points = times.filter(F.col("time").isNotNull()).select(
        "*", epoch_second(F.col("time")).alias("second"), micro_of_second(F.col("time")).alias("offset")
    )
    kept = ["time", "records", *_SUMS]
    total = join_limbs(F.col("high"), F.col("low"))
    untimed = times.filter(F.col("time").isNull())
    return (
        _frames(points, half_width)
        .select(kept)
        .unionByName(untimed.select(kept))
        .select("time", F.try_divide(total, F.col("n").cast("double")).alias("average"), "records")
    )


def _frames(points: DataFrame, half_width: int) -> DataFrame:
    """``points`` with each sum taken over its frame.

    The seconds at the ends and the time's own second come from the seconds of its remainder,
    those between the ends from the sums per second, without its own.
    """
    seconds = points.groupBy("second").agg(*[F.sum(c).alias(c) for c in _SUMS])
    between = _range_sums(seconds, "second", half_width - 1, own=False).select(
        "second", *[F.col(c).alias(f"between_{c}") for c in _SUMS]
    )
    placed = points.withColumns(
        {
            "remainder": F.pmod("second", F.lit(half_width)),
            "place": F.expr(f"(second - pmod(second, {half_width}L)) div {half_width}L * {_SECOND}L + offset"),
        }
    )
    ends = _range_sums(placed, "place", _SECOND, "remainder")
    return ends.join(between, "second").withColumns({c: F.col(c) + F.col(f"between_{c}") for c in _SUMS})


def _bucket(at: str, width: int) -> Column:
    return F.expr(f"({at} - pmod({at}, {width}L)) div {width}L")


def _range_sums(points: DataFrame, at: str, reach: int, *apart: str, own: bool = True) -> DataFrame:
    """``points`` with each sum taken over all points within ``reach`` of ``at``, which is unique
    for equal values of ``apart``; without the point's ``own`` values if asked so."""
    width = max(12 * reach, 1)
    buckets = F.sequence(_bucket(f"({at} - {reach}L)", width), _bucket(f"({at} + {reach}L)", width))
    copies = points.withColumn("bucket", F.explode(buckets))
    bucket = Window.partitionBy(*apart, "bucket").orderBy(at)
    up_to_end = bucket.rangeBetween(Window.unboundedPreceding, reach)
    before_start = bucket.rangeBetween(Window.unboundedPreceding, -reach - 1)
    sums = {
        c: F.sum(c).over(up_to_end)
        - F.coalesce(F.sum(c).over(before_start), F.lit(0))
        - (F.lit(0) if own else F.col(c))
        for c in _SUMS
    }
    return copies.withColumns(sums).filter(F.col("bucket") == _bucket(at, width)).drop("bucket")

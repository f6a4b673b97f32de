"""Record and traffic totals.

Megabytes are decimal (10^6 bytes) and the division is floating point.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logmill.functions import hour_of_day, join_limbs, limbs, wide_sum


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def total_mb(df: DataFrame, value: str = "bytes") -> DataFrame:
    return df.agg(_mb(wide_sum(F.col(value))).alias("total_mb"))


def mb_by(df: DataFrame, key: str, value: str = "bytes") -> DataFrame:
    """Megabytes per ``key``, groups above zero only, smallest first."""
    return _above_zero(df.groupBy(key).agg(_mb(wide_sum(F.col(value))).alias("MB")))


def mb_by_hour(df: DataFrame, time: str = "datetime", value: str = "bytes") -> DataFrame:
    """Megabytes per hour of day, all days together, in order of the hour."""
    # Grouped by the number; the text is made for the 24 results only.
    sums = df.groupBy(F.hour(time).alias("hour")).agg(_mb(wide_sum(F.col(value))).alias("MB"))
    return _by_hour(sums)


CELL_SCHEMA = "status bigint, method string, hour int, records bigint, high bigint, low bigint"


def traffic_cells(df: DataFrame, *keys: str) -> DataFrame:
    """Row count and byte sums per status, method and hour, for each of ``keys``.

    One pass over the table; every total of the report is a sum over these few
    rows (``*_from_cells``). Cells of parts of a table, put together, are cells of it.
    """
    high, low = limbs(F.col("bytes"))
    return df.groupBy("status", "method", F.hour("datetime").alias("hour"), *keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(high).alias("high"),
        F.sum(low).alias("low"),
    )


def records_from_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_records"))


def mb_from_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(_mb(_cell_sum()).alias("total_mb"))


def mb_by_from_cells(cells: DataFrame, key: str) -> DataFrame:
    return _above_zero(cells.groupBy(key).agg(_mb(_cell_sum()).alias("MB")))


def mb_by_hour_from_cells(cells: DataFrame) -> DataFrame:
    return _by_hour(cells.groupBy("hour").agg(_mb(_cell_sum()).alias("MB")))


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps only ``n`` rows per group and task before the shuffle, so a hot
    group costs no more to move than any other.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("row_number", first).filter(F.col("row_number") <= n).drop("row_number")


TOP_SCHEMA = "hour int, bytes bigint, datetime timestamp_ntz, request string, host string, hostname string"


def top_rows_by_hour(df: DataFrame, *keys: str) -> DataFrame:
    """The largest request of each hour of day, for each of ``keys``: ``TOP_SCHEMA`` and these.

    Equal sizes go to the earliest request, then by request, host and host name. The largest size
    of each hour is a hash aggregate; its rows, a few per hour, are then found by a join with the
    few sizes, and only ties are ordered. The records are not sorted. Without ``keys`` the sizes
    are 25 at most. The top rows of parts of a table, put together, have the table's top rows.
    """
    rows = df.select(F.hour("datetime").alias("hour"), "bytes", "datetime", "request", "host", "hostname", *keys)
    return _tops(rows, *keys)


def _tops(rows: DataFrame, *keys: str) -> DataFrame:
    groups = ["hour", *keys]
    most = rows.groupBy(*[F.col(k).alias(f"top_{k}") for k in groups]).agg(F.max("bytes").alias("most"))
    same = F.col("bytes").eqNullSafe(F.col("most"))
    for k in groups:
        same &= F.col(k).eqNullSafe(F.col(f"top_{k}"))
    tie = F.struct("datetime", "request", "host", "hostname")
    found = rows.join(most if keys else F.broadcast(most), same)
    first = found.groupBy(*groups, "bytes").agg(F.min(tie).alias("first"))
    return first.select("hour", "bytes", "first.*", *keys)


def top_bytes_by_hour(df: DataFrame) -> DataFrame:
    """The largest request of each hour of day: hour, host name, kilobytes, in order of the hour.
    ``top_n_per_group`` is the way for more than one row."""
    return _ordered_tops(top_rows_by_hour(df))


def top_from_tops(tops: DataFrame) -> DataFrame:
    """As ``top_bytes_by_hour``, of a table whose parts have these top rows."""
    return _ordered_tops(_tops(tops))


def _ordered_tops(tops: DataFrame) -> DataFrame:
    return tops.orderBy(F.col("hour").asc_nulls_last()).select(
        hour_of_day(F.col("hour")).alias("dt"), "hostname", (F.col("bytes") / 1000).alias("KB")
    )


def _mb(total: Column) -> Column:
    return total / 1000 / 1000


def _cell_sum() -> Column:
    return join_limbs(F.sum("high"), F.sum("low"))


def _above_zero(sums: DataFrame) -> DataFrame:
    return sums.filter(F.col("MB") > 0).orderBy(F.col("MB").asc_nulls_last())


def _by_hour(sums: DataFrame) -> DataFrame:
    ordered = sums.orderBy(F.col("hour").asc_nulls_last())
    return ordered.select(hour_of_day(F.col("hour")).alias("log_hour"), "MB")

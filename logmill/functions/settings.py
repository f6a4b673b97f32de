"""Session settings for the length of one job."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a join's input, as Spark estimates them, that one shuffle partition should hold.
PARTITION_BYTES = 128 << 20
#: Files that a task of a write into folders keeps open at once: by default Spark opens one, and
#: for that sorts the task's rows, all of which it holds. Only rows of further folders are sorted.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings in force inside the block, as they were after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a scan's size: its files' bytes, by the columns read. No job runs.
    Of a join it is the product of both sides, so give it what is joined."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` is made from, as Spark knows them; one that is read twice counts
    twice, one of unknown size as very large. No job runs."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))


def shuffled_by_size(df: DataFrame, bytes_: int | None = None, partition_bytes: int = PARTITION_BYTES):
    """Shuffle partitions enough for ``df`` (or so many bytes), never fewer than the session has.

    AQE merges partitions that turn out small; it cuts evenly large ones no further, so their
    number has to come from the input.
    """
    spark = df.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-(estimated_bytes(df) if bytes_ is None else bytes_) // partition_bytes)
    return settings(spark, {"spark.sql.shuffle.partitions": str(max(usual, min(wanted, 1 << 20)))})

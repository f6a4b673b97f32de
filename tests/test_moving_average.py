import random
from datetime import datetime, timedelta

import pytest
from conftest import first_plan
from pyspark.sql import functions as F

from logmill.operators import moving_average
from logmill.operators.moving_average import moving_avg_per_record, range_moving_avg

SCHEMA = "datetime timestamp_ntz, bytes bigint"
MICRO = timedelta(microseconds=1)


def direct(df, half_width):
    """The window as SQL has it, in one partition."""
    df.createOrReplaceTempView("direct_input")
    return df.sparkSession.sql(f"""
        SELECT datetime, avg(bytes) OVER (ORDER BY datetime RANGE BETWEEN INTERVAL {half_width} SECONDS PRECEDING
          AND INTERVAL {half_width} SECONDS FOLLOWING) AS moving_avg
        FROM direct_input""")


def times(half_width):
    """Around bucket borders and frame ends, close together and far apart, before 1970 and without time."""
    rng = random.Random(half_width)
    width = timedelta(seconds=half_width)
    epoch = datetime(1970, 1, 1)
    out = [None, None, None]
    for base in (epoch, epoch + 12 * width, epoch - 12 * width, datetime(2019, 1, 22), datetime(1900, 1, 1)):
        for shift in (-width, -MICRO, timedelta(0), MICRO, width, width + MICRO, 2 * width, 13 * width):
            out += [base + shift] * rng.choice([1, 1, 3])
        for _ in range(40):
            out.append(base + timedelta(seconds=rng.randrange(-30 * half_width, 30 * half_width)))
            out.append(base + timedelta(microseconds=rng.randrange(-3 * half_width * 10**6, 3 * half_width * 10**6)))
    return out


@pytest.mark.parametrize("half_width", [1, 2, 90, 7200])
def test_equals_the_direct_window(spark, half_width):
    rng = random.Random(1)
    rows = [(t, rng.choice([None, rng.randrange(10**6), -5, 2**40 + n])) for n, t in enumerate(times(half_width))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = {(r["datetime"], r["moving_avg"]) for r in direct(df, half_width).collect()}
    got = range_moving_avg(df, "datetime", "bytes", half_width).collect()
    assert len(got) == len(want) == len({t for t, _ in rows})
    assert sum(r["records"] for r in got) == len(rows)
    want_by_time = dict(want)
    for r in got:
        average = want_by_time[r["datetime"]]
        assert r["moving_avg"] == (None if average is None else pytest.approx(average, rel=1e-12)), r


def test_large_values_do_not_overflow(spark):
    start = datetime(2019, 1, 22)
    df = spark.createDataFrame([(start + timedelta(minutes=n), 2**63 - 1) for n in range(20)], SCHEMA)
    assert {r["moving_avg"] for r in range_moving_avg(df, "datetime", "bytes", 7200).collect()} == {float(2**63 - 1)}


def test_many_times_in_few_seconds(spark):
    start = datetime(2019, 1, 22)
    rows = [(start + timedelta(seconds=n % 40, microseconds=n * 7919 % 10**6), n) for n in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = dict((r["datetime"], r["moving_avg"]) for r in direct(df, 2).collect())
    got = range_moving_avg(df, "datetime", "bytes", 2)
    assert {r["datetime"]: r["moving_avg"] for r in got.collect()} == pytest.approx(want)


def test_one_row_per_record_in_order(spark, monkeypatch):
    """A time with many records is written out in several pieces, whole."""
    monkeypatch.setattr(moving_average, "_ROWS_PER_TASK", 100)
    start = datetime(2019, 1, 22)
    rows = [(start, 10)] * 300 + [(start + timedelta(minutes=7 * n), n) for n in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = moving_avg_per_record(df)
    got = [tuple(r) for r in out.collect()]
    want = sorted((f"{r['datetime'].hour:02d}", r["moving_avg"]) for r in direct(df, 7200).collect())
    assert [h for h, _ in got] == [h for h, _ in want]
    assert [v for _, v in got] == pytest.approx([v for _, v in want])
    assert max(r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 200


def test_plan_has_no_global_window(spark):
    rows = spark.range(0, 5000, 1, 4).select(
        F.expr("timestamp_ntz'2019-01-22' + make_dt_interval(0, 0, cast(id as int), 0)").alias("datetime"),
        F.col("id").alias("bytes"),
    )
    for df in (range_moving_avg(rows, "datetime", "bytes", 7200), moving_avg_per_record(rows)):
        plan = first_plan(df)
        assert "SinglePartition" not in plan
        assert "Python" not in plan
    assert moving_avg_per_record(rows).count() == 5000


def test_does_not_depend_on_the_zone(spark, setting):
    df = spark.createDataFrame([(datetime(2019, 3, 10, 1, 0) + timedelta(minutes=n), n) for n in range(300)], SCHEMA)
    before = range_moving_avg(df, "datetime", "bytes", 3600).orderBy("datetime").collect()
    setting("spark.sql.session.timeZone", "America/New_York")
    assert range_moving_avg(df, "datetime", "bytes", 3600).orderBy("datetime").collect() == before


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert moving_avg_per_record(empty).count() == 0
    with pytest.raises(TypeError):
        range_moving_avg(empty.withColumn("bytes", F.lit(1.5)), "datetime", "bytes", 10)
    with pytest.raises(ValueError):
        range_moving_avg(empty, "datetime", "bytes", 0)

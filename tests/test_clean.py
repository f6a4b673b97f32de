from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logmill.operators.clean import clean, map_column

TIMES = [
    ("22/Jan/2019:03:56:14 +0330", datetime(2019, 1, 22, 3, 56, 14, 33000), datetime(2019, 1, 22, 0, 26, 14)),
    ("22/Jan/2019:03:56:14 +0000", datetime(2019, 1, 22, 3, 56, 14), datetime(2019, 1, 22, 3, 56, 14)),
    ("22/Jan/2019:03:56:14 -0500", None, datetime(2019, 1, 22, 8, 56, 14)),
    ("22/Jan/2019:03:56:14 -0030", None, datetime(2019, 1, 22, 4, 26, 14)),
    ("22/Jan/2019:03:56:14 +123456", datetime(2019, 1, 22, 3, 56, 14, 123456), None),
    ("1/jan/2019:3:5:4 +5", datetime(2019, 1, 1, 3, 5, 4, 500000), None),
    ("22/Jan/2019:03:56:60 +0330", None, None),
    ("22/Jan/2019:24:00:00 +0330", None, None),
    ("31/Feb/2019:03:56:14 +0330", None, None),
    ("22/Jnn/2019:03:56:14 +0330", None, None),
    ("22/Jan/19:03:56:14 +0330", None, None),
    ("01/Jan/0000:00:00:00 +0000", None, None),
    ("22/Jan/2019:03:56:14", None, None),
    ("22/Jan/2019:03:56:14 +1234567", None, None),
    ("2019-01-22 03:56:14", None, None),
    ("", datetime(1900, 1, 1), datetime(1900, 1, 1)),
]


def fields(spark, **values):
    row = {"bytes": "1", "status": "200", "datetime": TIMES[1][0], **values}
    return spark.createDataFrame([row], "bytes string, status string, datetime string")


@pytest.mark.parametrize("mode", ["reference", "utc"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, setting, mode, zone):
    setting("spark.sql.session.timeZone", zone)
    rows = [(n, t[0], "1", "200") for n, t in enumerate(TIMES)]
    df = spark.createDataFrame(rows, "n int, datetime string, bytes string, status string")
    got = [r["datetime"] for r in clean(df, mode, "null").orderBy("n").collect()]
    assert got == [t[1 if mode == "reference" else 2] for t in TIMES]


def test_times_equal_python(spark):
    """Python's own reading of the format, failures included."""

    def python(text):
        try:
            return datetime.strptime(text, "%d/%b/%Y:%H:%M:%S +%f")
        except ValueError:
            return None

    texts = [t[0] for t in TIMES[:-1]] + [
        " 1/Jan/2019:03:56:14 +0330",
        " 12/Jan/2019:03:56:14 +0330",
        "0/Jan/2019:03:56:14 +0330",
        "29/Feb/2020:3:06:4   +000001",
        "29/FEB/2020:23:59:59\t+1",
        "12/Dec/9999:23:59:59 +999999",
        "12/Dec/2019:03:56:14 +0330 ",
        "12/Dec/2019:03:56:14 + 330",
        "12/Dec/2019:03:56:14+0330",
    ]
    df = spark.createDataFrame([(n, t, "1", "1") for n, t in enumerate(texts)], "n int, datetime string, bytes string, status string")
    got = [r["datetime"] for r in clean(df, on_bad_value="null").orderBy("n").collect()]
    assert got == [python(t) for t in texts]


def test_time_in_a_zone_gap(spark, setting):
    """Half past two on the night the clocks go forward is a time like any other."""
    setting("spark.sql.session.timeZone", "America/New_York")
    df = clean(fields(spark, datetime="10/Mar/2019:02:30:00 +0000"))
    assert df.first()["datetime"] == datetime(2019, 3, 10, 2, 30)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    for text, number in (("12", 12), ("+5", 5), ("-7", -7), ("007", 7)):
        row = clean(fields(spark, bytes=text, status=text)).first()
        assert (row["bytes"], row["status"]) == (number, number)
    assert clean(fields(spark, bytes="-")).first()["bytes"] == 0
    for bad in ({"bytes": "1.5"}, {"status": "-"}, {"status": "1.5"}, {"bytes": "9223372036854775808"}):
        (name,) = bad
        with pytest.raises(Exception, match=f"bad {name} in log line"):
            clean(fields(spark, **bad)).collect()
        assert clean(fields(spark, **bad), on_bad_value="null").first()[name] is None


def test_bad_time_stops_the_job(spark):
    with pytest.raises(Exception, match="bad datetime in log line"):
        clean(fields(spark, datetime="22/Jan/2019:03:56:14 -0500")).collect()


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        clean(fields(spark), offset_mode="local")
    with pytest.raises(ValueError):
        clean(fields(spark), on_bad_value="skip")


def test_map_column(spark):
    df = fields(spark, bytes="ab")
    assert map_column(df, "bytes", F.upper).first()["bytes"] == "AB"
    assert map_column(df, "bytes", lambda text: text * 2, "string").first()["bytes"] == "abab"
    assert map_column(map_column(df, "bytes", len, "bigint"), "bytes", lambda n: n + 1).first()["bytes"] == 3


def test_map_column_gives_plain_values(spark):
    """Large integers stay exact beside nulls, and times are datetimes."""
    rows = [(2**62 + 1, datetime(2019, 1, 22, 3, 56, 14, 33000)), (None, None)]
    df = spark.createDataFrame(rows, "bytes bigint, datetime timestamp_ntz")
    df = map_column(df, "bytes", lambda v: repr(v), "string")
    df = map_column(df, "datetime", lambda t: t and t.replace(microsecond=0), "timestamp_ntz")
    assert [tuple(r) for r in df.collect()] == [(str(2**62 + 1), datetime(2019, 1, 22, 3, 56, 14)), ("None", None)]


def test_batch_function(spark):
    """Whole Arrow batches, nulls and empty partitions included."""
    import pyarrow as pa
    import pyarrow.compute as pc

    df = spark.createDataFrame([("ab", 1), (None, 2), ("", 3), ("xyz", None)], "request string, bytes long").repartition(6)
    out = map_column(df, "request", pc.utf8_reverse, "string", batches=True)
    out = map_column(out, "bytes", lambda sizes: pc.add(sizes, 1), "long", batches=True)
    assert sorted(out.collect(), key=str) == sorted([("ba", 2), (None, 3), ("", 4), ("zyx", None)], key=str)
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    chunked = map_column(df, "bytes", lambda sizes: pa.chunked_array([sizes]), "long", batches=True)
    assert sorted(chunked.collect(), key=str) == sorted(df.collect(), key=str)
    assert map_column(df.limit(0), "bytes", lambda sizes: sizes, "long", batches=True).count() == 0
    with pytest.raises(ValueError):
        map_column(df, "bytes", lambda sizes: sizes, batches=True)
    with pytest.raises(Exception, match="(?i)length|size|shape"):
        map_column(df, "bytes", lambda sizes: pa.array([1, 2, 3, 4, 5, 6, 7]), "long", batches=True).collect()

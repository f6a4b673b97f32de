"""Reports as SQL text, as a notebook would send them."""

from datetime import datetime, timedelta

import pytest
from conftest import first_plan
from pyspark.sql import functions as F

from logmill.functions.sql import register


@pytest.fixture
def table(spark):
    start = datetime(2019, 1, 22)
    rows = [
        (f"h{n % 5}", start + timedelta(minutes=n * 7), "GET" if n % 3 else "POST", f"/{n}", 200 + n % 2, n * 1001 % 977, f"n{n}")
        for n in range(500)
    ]
    df = spark.createDataFrame(
        rows,
        "host string, datetime timestamp_ntz, method string, request string, status bigint, bytes bigint, hostname string",
    )
    df.createOrReplaceTempView("log")
    register(spark)
    yield df
    spark.catalog.dropTempView("log")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_hour_text_and_having_by_alias(spark, table):
    busy = """
        SELECT host, strftime(datetime, '%H') AS at, max(status) AS worst, count(*) AS requests
        FROM log WHERE method = 'POST' GROUP BY host, at HAVING requests > 1"""
    hour = F.date_format("datetime", "HH").alias("at")
    own = table.filter("method = 'POST'").groupBy("host", hour).agg(F.max("status").alias("worst"), F.count("*").alias("n"))
    assert sorted(rows(spark.sql(busy))) == sorted(rows(own.filter("n > 1")))
    assert "Python" not in first_plan(spark.sql(busy))


def test_chained_expressions_and_named_window(spark, table):
    quiet = """
        WITH per_host AS (SELECT host, request, length(request) AS size FROM log),
             placed AS (SELECT host, request, rank() OVER w AS place, lag(size) OVER w AS before
                        FROM per_host WINDOW w AS (PARTITION BY host ORDER BY size DESC, request))
        SELECT host, request, before FROM placed WHERE place <= 2"""
    got = sorted(rows(spark.sql(quiet)), key=str)
    want = []
    for host in {r["host"] for r in table.collect()}:
        own = sorted((r["request"] for r in table.collect() if r["host"] == host), key=lambda r: (-len(r), r))
        want += [(host, own[0], None), (host, own[1], len(own[0]))]
    assert got == sorted(want, key=str)


def test_other_formats_are_an_error(spark, table):
    with pytest.raises(Exception, match="only the format"):
        table.select(F.expr("strftime(datetime, '%d')")).collect()

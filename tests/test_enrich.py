from datetime import datetime

from conftest import final_plan
from pyspark.sql import functions as F

from logmill.operators.enrich import join_hostnames
from logmill.schema import JOINED_COLUMNS, LOG_SCHEMA


def logs(spark, hosts):
    """A log record per row of ``hosts`` (host, request)."""
    fixed = {"bytes": 1, "status": 200, "datetime": datetime(2019, 1, 22)}
    return hosts.select(
        *[
            F.col(f.name) if f.name in ("host", "request") else F.lit(fixed.get(f.name, "-")).cast(f.dataType).alias(f.name)
            for f in LOG_SCHEMA
        ]
    )


def test_left_join(spark):
    rows = logs(spark, spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("a", "4")], "host string, request string"))
    names = spark.createDataFrame([("a", "A1", 1), ("a", "A2", 2), ("b", "", 3), ("z", "Z", 4)], "client string, hostname string, extra int")
    got = join_hostnames(rows, names)
    assert tuple(got.columns) == JOINED_COLUMNS
    assert sorted((r["request"], r["hostname"]) for r in got.filter("hostname is not null").collect()) == [
        ("1", "A1"), ("1", "A2"), ("2", ""), ("4", "A1"), ("4", "A2"),
    ]
    assert [r["request"] for r in got.filter("hostname is null").collect()] == ["3"]


def test_hot_host_is_cut(spark, setting):
    """One host with a third of the rows, names too large to broadcast."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64kb")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64kb")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    host = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 1000))
    rows = logs(spark, spark.range(0, 60000, 1, 8).select(host.alias("host"), F.uuid().alias("request")))
    names = spark.range(1000).select(F.concat(F.lit("h"), "id").alias("client"), F.lit("n").alias("hostname"))
    names = names.union(spark.createDataFrame([("hot", "hot name")], names.schema))
    got = join_hostnames(rows, names)
    assert "skew=true" in final_plan(got)
    assert got.count() == 60000
    assert got.filter("hostname = 'hot name'").count() == 20000


def test_small_names_are_broadcast_by_size(spark):
    host = F.concat(F.lit("h"), F.col("id") % 3)
    rows = logs(spark, spark.range(0, 1000, 1, 4).select(host.alias("host"), F.lit("1").alias("request")))
    names = spark.range(2).select(F.concat(F.lit("h"), "id").alias("client"), F.lit("n").alias("hostname"))
    got = join_hostnames(rows, names)
    assert "BroadcastHashJoin" in final_plan(got)
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()

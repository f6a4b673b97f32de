"""Joins of records that are kept by host."""

import pytest
from conftest import final_plan, first_plan
from pyspark.sql import functions as F
from test_pipeline import GOOD, make
from test_run_table import TABLE, place, table, whole  # noqa: F401  (a fixture)

from logmill.operators.enrich import join_hostnames
from logmill.sources.host_buckets import HostBuckets
from logmill.sources.runs import RUN, Runs
from logmill.sources.text import read_hostnames

HOT = ['10.0.0.2 - - [22/Jan/2019:03:56:14 +0330] "GET /hot/%d HTTP/1.1" 200 %d "-" "ua"' % (n, n) for n in range(300)]


@pytest.fixture
def by_host(spark, tmp_path):
    buckets = HostBuckets(spark, "records_by_host", f"{tmp_path}/by_host", 8)
    yield buckets
    buckets.drop()


def load(spark, folder, lines, name):
    pipe = make(spark, folder, run=name).extract_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
    return pipe.clean_log_record().load_to_data_lake().runs


@pytest.mark.parametrize("partitions", ["4", "40"])
def test_the_log_side_stays(spark, place, by_host, setting, partitions):  # noqa: F811
    """No Exchange between the records and the join, fewer or more shuffle partitions than buckets."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", partitions)
    runs = load(spark, place, GOOD + HOT, "one")
    assert by_host.sync(runs) == {"added": 1, "runs": 1} and by_host.buckets() == 8
    names = read_hostnames(spark, f"{place}/names.csv")
    joined = by_host.joined(names, [m["folder"] for m in runs.live()])
    for plan in (first_plan(joined), final_plan(joined)):
        final = plan.split("Initial Plan")[0]
        above = final[: final.index("Bucketed: true")]
        assert "SortMergeJoin" in above and "Exchange" not in above.split("SortMergeJoin")[1]
    want = join_hostnames(runs.rows(), names, RUN)
    assert sorted(joined.collect(), key=str) == sorted(want.collect(), key=str)
    # the hot host is cut: no bucket holds more than a few pieces of an even share
    tasks = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert tasks[0] <= 4 * len(GOOD + HOT) / 8 and tasks[1] >= 5


def test_runs_are_added_and_dropped(spark, place, by_host):  # noqa: F811
    load(spark, place, GOOD[:20], "one")
    runs = load(spark, place, HOT, "two")
    assert by_host.sync(runs) == {"added": 2, "runs": 2}
    assert by_host.sync(runs) == {"added": 0, "runs": 2}
    load(spark, place, GOOD[20:] + HOT[:10], "three")  # a host that was cut before
    load(spark, place, ["no log line"], "four")
    assert by_host.sync(runs)["added"] == 2
    names = read_hostnames(spark, f"{place}/names.csv")
    names = names.union(names.withColumn("hostname", F.lit("again")))

    def check():
        got = by_host.joined(names, [m["folder"] for m in runs.live()])
        assert sorted(got.collect(), key=str) == sorted(join_hostnames(runs.rows(), names, RUN).collect(), key=str)

    check()
    runs.compact()
    assert by_host.sync(runs) == {"added": 1, "runs": 1}
    assert by_host.runs() == {m["folder"] for m in runs.live()}
    check()
    some = by_host.joined(names, [])
    assert some.count() == 0


def test_killed_add(spark, place, by_host, monkeypatch):  # noqa: F811
    runs = load(spark, place, GOOD[:20] + HOT, "one")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(HostBuckets, "_alter", dies)
        with pytest.raises(KeyboardInterrupt):
            by_host.sync(runs)
    by_host.sync(runs)
    names = read_hostnames(spark, f"{place}/names.csv")
    assert by_host.joined(names, [m["folder"] for m in runs.live()]).count() == 320


def test_pipeline_with_buckets(spark, place):  # noqa: F811
    for n, lines in enumerate((GOOD[:20], GOOD[20:] + HOT, GOOD[:20])):
        pipe = make(spark, place, table=TABLE, table_mode="runs", buckets=4, run=f"run{n % 2}")
        frame = spark.createDataFrame([(v,) for v in lines], "value string")
        pipe.extract_lines(frame, f"{place}/names.csv").clean_log_record().load_to_data_lake()
        pipe.transform_data().load_datawarehouse()
        assert pipe.counts["joined"] == (n < 2)
        assert table(spark) == whole(spark, place)
    with open(f"{place}/names.csv", "a") as names:
        names.write("10.0.0.1,host one\n")
    pipe = make(spark, place, table=TABLE, table_mode="runs", buckets=4, run="run0").extract_lines(frame, f"{place}/names.csv")
    pipe.clean_log_record().load_to_data_lake().transform_data().load_datawarehouse()
    assert pipe.counts["joined"] == 2 and len(table(spark)) == 340 and table(spark) == whole(spark, place)
    assert Runs(spark, f"{place}/output").live() and HostBuckets(spark, f"{TABLE}_by_host").buckets() == 4

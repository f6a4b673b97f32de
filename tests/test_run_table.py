"""The table that grows by runs equals one that is built whole."""

import pytest
from conftest import files_read, first_plan
from pyspark.sql import functions as F
from test_pipeline import BAD, GOOD, make

from logmill.operators import enrich, traffic
from logmill.plans import report
from logmill.sources import lake
from logmill.sources.run_table import RunTable, names_hash
from logmill.sources.runs import Runs
from logmill.sources.text import read_hostnames

TABLE = "grown_log_table"


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "names.csv").write_text("client,hostname\n" + "".join(f"10.0.0.{n},host{n}\n" for n in range(0, 40, 2)))
    yield tmp_path
    for t in [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{TABLE}*'").collect()]:
        kind = "VIEW" if t == TABLE else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {t}")


def run(spark, place, lines, name, **options):
    pipe = make(spark, place, table=TABLE, table_mode="runs", run=name, **options)
    frame = spark.createDataFrame([(v,) for v in lines], "value string").repartition(2)
    pipe.extract_lines(frame, f"{place}/names.csv").clean_log_record().load_to_data_lake()
    return pipe.transform_data().load_datawarehouse()


def whole(spark, place):
    """The join of the whole lake, in order."""
    joined = enrich.join_hostnames(lake.read_lake(spark, f"{place}/output"), read_hostnames(spark, f"{place}/names.csv"))
    return sorted(joined.collect(), key=str)


def table(spark):
    return sorted(spark.table(TABLE).collect(), key=str)


def test_runs_equal_one_rebuild(spark, place):
    assert run(spark, place, GOOD[:15] + BAD, "one").counts["joined"] == 1
    assert run(spark, place, GOOD[15:], "two").counts["joined"] == 1
    assert run(spark, place, GOOD[:15] + BAD, "one").counts["joined"] == 0
    assert run(spark, place, BAD, "three").counts["joined"] == 1  # no record at all
    assert run(spark, place, BAD, "three").counts["joined"] == 0
    assert len(table(spark)) == 40 and table(spark) == whole(spark, place)
    assert [r["col_name"] for r in report(spark, f"{place}/errors", TABLE)["describe"].collect()] == spark.table(TABLE).columns


def test_new_names_rebuild(spark, place, monkeypatch):
    monkeypatch.setattr("logmill.sources.run_table._AT_ONCE", 1)
    run(spark, place, GOOD[:20], "one")
    before = RunTable(spark, TABLE).state()
    with open(f"{place}/names.csv", "a") as names:
        names.write("10.0.0.1,host one\n10.0.0.2,second name\n")
    assert run(spark, place, GOOD[20:], "two").counts["joined"] == 2
    assert len(table(spark)) == 41 and table(spark) == whole(spark, place)
    after = RunTable(spark, TABLE).state()
    assert after["logmill.rows"] != before["logmill.rows"]
    assert not spark.catalog.tableExists(before["logmill.rows"])
    assert [p.name for p in (place / "table").iterdir()] == [after["logmill.rows"]]  # the old files are gone


@pytest.mark.parametrize("step", ["_exchange", "sql"])
def test_killed_loads(spark, place, monkeypatch, step):
    """Killed before the view is exchanged, or before a run's partition is added: the table stays as it was."""
    run(spark, place, GOOD[:10], "one")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "_exchange":
            (place / "names.csv").write_text("client,hostname\n10.0.0.1,x\n")
            m.setattr(RunTable, "_exchange", dies)
        else:
            m.setattr("logmill.sources.run_table.Store.make_folder", dies)
        with pytest.raises(KeyboardInterrupt):
            run(spark, place, GOOD[10:], "two")
    assert len(table(spark)) == 10
    run(spark, place, GOOD[10:], "two")
    assert len(table(spark)) == 40 and table(spark) == whole(spark, place)


def test_totals_read_cells_only(spark, place):
    for n in range(3):
        run(spark, place, GOOD[n::3] + BAD, f"run{n}")
    out, records = report(spark, f"{place}/output", TABLE), spark.table(TABLE)
    single = {
        "total_records": traffic.total_records(records),
        "total_mb": traffic.total_mb(records),
        "mb_by_hour": traffic.mb_by_hour(records),
        "mb_by_status": traffic.mb_by(records, "status"),
        "mb_by_method": traffic.mb_by(records, "method"),
        "top_bytes_by_hour": traffic.top_bytes_by_hour(records),
    }
    for name, df in single.items():
        assert out[name].collect() == df.collect(), name
        scans = [x for x in first_plan(out[name]).splitlines() if "FileScan" in x]
        assert scans and all("_rows_" not in x for x in scans)
        assert files_read(out[name]) <= 3 * len(scans)
    assert out["total_errors"].first()["total_errors"] == 9


def test_rewritten_runs_are_known(spark, place):
    run(spark, place, GOOD[:10], "one")
    run(spark, place, GOOD[10:20], "two")
    runs = Runs(spark, f"{place}/output")
    assert runs.compact()["replaces"]
    assert run(spark, place, GOOD[:10], "one").counts["joined"] == 0
    run(spark, place, GOOD[20:30], "three")
    assert table(spark) == whole(spark, place) and len(table(spark)) == 30
    # a folder of which the table has a part: all is joined again
    pipe = make(spark, place, run="four").extract_lines(spark.createDataFrame([(v,) for v in GOOD[30:]], "value string"))
    pipe.clean_log_record().load_to_data_lake()
    runs.compact()
    assert run(spark, place, [], "five").counts["joined"] == 2
    assert table(spark) == whole(spark, place) and len(table(spark)) == 40


def test_a_plain_table_is_not_touched(spark, place):
    spark.range(3).write.saveAsTable(TABLE)
    with pytest.raises(ValueError, match="no table of runs"):
        run(spark, place, GOOD, "one")
    assert spark.table(TABLE).count() == 3
    spark.sql(f"DROP TABLE {TABLE}")


def test_names_hash(spark):
    names = spark.range(50).select(F.concat(F.lit("c"), "id").alias("client"), F.col("id").cast("string").alias("hostname"))
    assert names_hash(names) == names_hash(names.repartition(7).orderBy(F.desc("client")))
    others = [names.limit(49), names.union(names.limit(1)), names.union(names), names.select("client", F.lit("").alias("hostname"))]
    assert len({names_hash(n) for n in [names, *others]}) == 5
    assert names_hash(names.limit(0)) == names_hash(names.filter("false"))

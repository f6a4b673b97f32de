"""Runs of a lake: repeated, killed, of new files only, rewritten."""

import json
import os
import subprocess
import sys
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_pipeline import BAD, GOOD, make

from logmill.plans import LogPipeline, pipeline, report
from logmill.sources import lake, text
from logmill.sources.files import list_files, new_files
from logmill.sources.runs import Runs
from logmill.sources.store import Store


def load(spark, folder, lines, parts=3, **options):
    pipe = make(spark, folder, **options)
    frame = spark.createDataFrame([(v,) for v in lines], "value string").repartition(parts)
    return pipe.extract_lines(frame).clean_log_record().load_to_data_lake()


def dies(*_, **__):
    raise KeyboardInterrupt


def requests(spark, folder):
    return sorted(r["request"] for r in lake.read_lake(spark, f"{folder}/output").collect())


def wanted(lines):
    return sorted(line.split('"')[1].split()[1] for line in lines)


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    load(spark, tmp_path, GOOD[:20] + BAD, run="one")
    load(spark, tmp_path, GOOD[20:], run="two")
    again = load(spark, tmp_path, GOOD[:20] + BAD, run="one")
    assert again.counts == {"records": 20, "rejects": 3}
    assert requests(spark, tmp_path) == wanted(GOOD)
    assert sorted(r["value"] for r in text.read_rejects(spark, f"{tmp_path}/errors").collect()) == sorted(BAD)
    load(spark, tmp_path, GOOD[:20])  # a run without a name is always a new one
    assert requests(spark, tmp_path) == wanted(GOOD + GOOD[:20])


def test_a_killed_run_is_done_again(spark, tmp_path, monkeypatch):
    """Killed after its write, before its commit; then after its commit, before its text copy."""
    with monkeypatch.context() as m:
        m.setattr(Runs, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            load(spark, tmp_path, GOOD + BAD, run="one")
    assert len(list((tmp_path / "output").glob("run=one~*/outcome=log/*.parquet"))) > 0
    assert load(spark, tmp_path, GOOD + BAD, run="one").counts == {"records": 40, "rejects": 3}
    assert requests(spark, tmp_path) == wanted(GOOD)
    with monkeypatch.context() as m:
        m.setattr(LogPipeline, "_export", dies)
        with pytest.raises(KeyboardInterrupt):
            load(spark, tmp_path, GOOD[:1] + BAD, run="two")
    assert Runs(spark, f"{tmp_path}/output").rejects().count() == 6
    load(spark, tmp_path, [], run="two")
    assert text.read_rejects(spark, f"{tmp_path}/errors").count() == 6
    assert requests(spark, tmp_path) == wanted(GOOD + GOOD[:1])


def test_one_attempt_counts(spark, tmp_path):
    """Several attempts that have all written: one commits, the others get its marker."""
    runs, got = Runs(spark, f"{tmp_path}/output"), []
    folders = [runs.new_folder("same") for _ in range(6)]
    told = {"records": 0, "rejects": 0, "listing": None, "fields": [], "unread": [], "replaces": []}
    threads = [threading.Thread(target=lambda f=f: got.append(runs.commit("same", f, **told)["folder"])) for f in folders[1:]]
    first = runs.commit("same", folders[0], **told)["folder"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert set(got) == {first} and [m["folder"] for m in runs.live()] == [first]
    store = Store(spark, str(tmp_path))
    assert store.create_once(f"{tmp_path}/x/a", "1") and not store.create_once(f"{tmp_path}/x/a", "2")
    assert (tmp_path / "x" / "a").read_text() == "1" and len(list((tmp_path / "x").glob("[!.]*"))) == 1


def test_names_of_runs(spark, tmp_path):
    for name in ("", "a/b", "a~b", ".a", "a b", "a=b"):
        with pytest.raises(ValueError, match="run's name"):
            Runs(spark, f"{tmp_path}").new_folder(name)


@pytest.fixture
def logs(tmp_path):
    def write(name, lines):
        path = tmp_path / "logs" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return path

    write("a.log", GOOD[:10])
    write("x/b.log", GOOD[10:15])
    write("x/.old/c.log", GOOD[15:17])
    write("x/y/_d/e/f.log", GOOD[17:18])
    write("x/.old/.g.log", GOOD[:3])
    write("_h.log", GOOD[:3])
    write("_SUCCESS", [])
    write("_temporary/0/i.log", GOOD[:5])
    write("x/j.txt", GOOD[:5])
    return write


def run_new(spark, folder, **options):
    pipe = make(spark, folder, new_files_only=True, **options).extract_log(f"{folder}/logs", "*.log", None)
    return pipe.clean_log_record().load_to_data_lake()


def test_only_new_files_are_read(spark, tmp_path, logs):
    first = run_new(spark, tmp_path)
    assert first.counts["records"] == 18
    assert [Path(p).name for p in first.counts["unread"]] == ["_h.log", ".g.log"]
    assert requests(spark, tmp_path) == wanted(GOOD[:18])
    assert run_new(spark, tmp_path).counts["records"] == 0
    logs("x/new.log", GOOD[18:30])
    logs("x/.old/new.log", GOOD[30:])
    second = run_new(spark, tmp_path)
    assert sorted(Path(r["path"]).name for r in second.files.collect()) == ["new.log", "new.log"]
    assert requests(spark, tmp_path) == wanted(GOOD)
    # a run that wasn't committed hasn't read its files
    logs("last.log", GOOD[:1])
    make(spark, tmp_path, new_files_only=True).extract_log(f"{tmp_path}/logs", "*.log", None)
    assert run_new(spark, tmp_path).counts["records"] == 1


def test_names_that_look_like_patterns(spark, tmp_path, logs):
    for n, name in enumerate(("x{1}.log", "y[ab].log", "z*?.log", "a b+%20.log", "é.log", "x/[q]/{a,b}.log", ".k{/l[1].log")):
        logs(name, GOOD[30 + n : 31 + n])
    assert run_new(spark, tmp_path).counts["records"] == 25
    assert requests(spark, tmp_path) == wanted(GOOD[:18] + GOOD[30:37])


def test_runs_that_overlap(spark, tmp_path, logs):
    """Two runs list the same new files: one of them is committed."""
    slow = make(spark, tmp_path, new_files_only=True).extract_log(f"{tmp_path}/logs", "*.log", None).clean_log_record()
    assert run_new(spark, tmp_path).counts["records"] == 18
    with pytest.raises(RuntimeError, match="another run"):
        slow.load_to_data_lake()
    assert requests(spark, tmp_path) == wanted(GOOD[:18])


def test_a_load_that_is_tried_again(spark, tmp_path, monkeypatch):
    """The same pipeline object after a failed commit: what the first try wrote isn't in the way."""
    pipe = make(spark, tmp_path, run="one").extract_lines(spark.createDataFrame([(v,) for v in GOOD], "value string")).clean_log_record()
    with monkeypatch.context() as m:
        m.setattr(Runs, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            pipe.load_to_data_lake()
    assert pipe.load_to_data_lake().counts["records"] == 40
    assert requests(spark, tmp_path) == wanted(GOOD)


def test_changed_files(spark, tmp_path, logs):
    run_new(spark, tmp_path)
    path = logs("a.log", GOOD[:12])
    os.utime(path, (1, 1))
    with pytest.raises(Exception, match="has changed.*a.log"):
        run_new(spark, tmp_path)
    assert run_new(spark, tmp_path, on_changed="skip").counts["records"] == 0
    assert run_new(spark, tmp_path, on_changed="read").counts["records"] == 12
    assert run_new(spark, tmp_path).counts["records"] == 0
    with pytest.raises(ValueError):
        new_files(None, None, "ignore")


def test_a_committed_run_lists_nothing(spark, tmp_path, logs):
    assert run_new(spark, tmp_path, run="day").counts["records"] == 18
    logs("more.log", GOOD[30:])
    assert run_new(spark, tmp_path, run="day").counts["records"] == 18
    assert run_new(spark, tmp_path, run="next").counts["records"] == 10


@pytest.mark.parametrize("pattern", ["*.log", "x/*.log", "**/f.log", "[bc].log", ".old/*", "_*", "*"])
def test_listing_as_rglob(spark, tmp_path, logs, pattern):
    """All that rglob finds is listed, or told as unread where its own name is hidden."""
    root = tmp_path / "logs"
    listed = list_files(spark, str(root), pattern)
    got = sorted(r["path"].removeprefix("file:") for r in listed.files.collect())
    found = [p for p in root.rglob(pattern) if p.is_file() and "_temporary" not in p.parts and p.name != "_SUCCESS"]
    assert got == sorted(str(p) for p in found if p.name[0] not in "._")
    assert [p.removeprefix("file:") for p in listed.unread] == sorted(str(p) for p in found if p.name[0] in "._")


def test_rejects_as_a_view(spark, tmp_path):
    load(spark, tmp_path, GOOD[:2] + BAD, run="one", errors_location=None)
    load(spark, tmp_path, BAD[:1], run="two", errors_location=None)
    assert not (tmp_path / "errors").exists()
    Runs(spark, f"{tmp_path}/output").create_view("bad_lines")
    assert spark.sql("SELECT count(*) AS n FROM bad_lines WHERE value <> ''").first()["n"] == 3
    assert text.read_rejects(spark, f"{tmp_path}/output").count() == 4
    assert report(spark, f"{tmp_path}/output", "none")["total_errors"].first()["total_errors"] == 4


@pytest.mark.parametrize("fields", [[], ["status"]])
def test_compaction(spark, tmp_path, monkeypatch, fields):
    for n in range(4):
        load(spark, tmp_path, GOOD[10 * n : 10 * n + 10] + BAD, run=f"run{n}", parts=5, partition_field=fields if n else [])
    runs = Runs(spark, f"{tmp_path}/output")
    with monkeypatch.context() as m:  # fails after its write
        m.setattr(Runs, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            runs.compact()
    assert requests(spark, tmp_path) == wanted(GOOD)
    before = lake.read_lake(spark, f"{tmp_path}/output").orderBy("request").collect()
    marker = runs.compact()
    assert marker["records"] == 40 and marker["rejects"] == 12 and len(runs.live()) == 1
    assert runs.live()[0]["origins"] == {m["folder"] for m in runs.markers() if not m["replaces"]}
    assert lake.read_lake(spark, f"{tmp_path}/output").orderBy("request").collect() == before
    assert runs.rejects().count() == 12
    assert runs.sizes()[marker["folder"]][0] <= (2 if not fields else 4)
    assert runs.compact(1) is None  # nothing is small any more
    # a rewrite of folders that another one has replaced is void
    late = {k: marker[k] for k in ("records", "rejects", "listing", "fields", "unread", "replaces")}
    runs.commit("compact-late", runs.new_folder("compact-late"), **late)
    assert [m["folder"] for m in runs.live()] == [marker["folder"]]
    # a repeated run is still known
    load(spark, tmp_path, GOOD[:10], run="run0")
    assert requests(spark, tmp_path) == wanted(GOOD)
    assert runs.clean_up(1.0) == []
    assert len(runs.clean_up(0.0)) == 5 + 0 * len(fields)
    assert requests(spark, tmp_path) == wanted(GOOD)


def test_compaction_packs_by_size(spark, tmp_path):
    """Every file but the last holds about the wanted size; none is cut."""
    for n in range(6):
        load(spark, tmp_path, [g.replace("GET /", f"GET /{n}") for g in GOOD], run=f"r{n}", parts=4)
    runs = Runs(spark, f"{tmp_path}/output")
    count, size = (sum(x) for x in zip(*[runs.sizes()[m["folder"]] for m in runs.live()]))
    target = size // 3
    marker = runs.compact(target)
    assert count >= 18 and runs.sizes()[marker["folder"]][0] <= 7
    assert lake.read_lake(spark, f"{tmp_path}/output").count() == 240


_TWO_LAKES = """
import sys

from pyspark.sql import SparkSession

from test_pipeline import BAD, GOOD, make
from test_runs import load
from logmill.sources.runs import Runs

top = sys.argv[1]
options = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{top}/log", "spark.eventLog.compress": "false",
           "spark.eventLog.rolling.enabled": "false", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
           "spark.sql.warehouse.dir": f"{top}/tables", "spark.checkpoint.dir": f"{top}/shared"}
spark = SparkSession.builder.master("local[2]").config(map=options).getOrCreate()
for fields in ([], ["status"]):
    for n in range(2):
        load(spark, f"{top}/lake{len(fields)}", GOOD + BAD, run=f"run{n}", partition_field=fields, errors_location=None)
    Runs(spark, f"{top}/lake{len(fields)}/output").compact()
spark.stop()
"""


def test_lake_writes_do_not_sort(tmp_path):
    """Loads and compactions write rows as they come; a sort by folder would hold all of a task."""
    (tmp_path / "log").mkdir()
    env = os.environ | {"PYTHONPATH": os.pathsep.join(map(str, (Path(__file__).parent, Path(__file__).parent.parent)))}
    subprocess.run([sys.executable, "-c", _TWO_LAKES, str(tmp_path)], env=env, check=True, timeout=300)
    plans = {}
    for line in next((tmp_path / "log").iterdir()).read_text().splitlines():
        event = json.loads(line)
        if "physicalPlanDescription" in event:
            plans[event["executionId"]] = event["physicalPlanDescription"]
    writes = [p for p in plans.values() if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(writes) == 6 and all("outcome" in p for p in writes)
    assert not [p for p in writes if "Sort" in p]


def test_more_folders_than_open_files(spark, tmp_path):
    """One task writes 40 folders, each once."""
    for n in range(2):
        load(spark, tmp_path, GOOD + BAD, parts=1, run=f"run{n}", partition_field=["request", "status"])
    runs = Runs(spark, f"{tmp_path}/output")
    folders = len({(line.split('"')[1].split()[1], line.split('"')[2].split()[0]) for line in GOOD}) + 1
    assert [runs.sizes()[m["folder"]][0] for m in runs.live()] == [folders] * 2
    marker = runs.compact()
    assert runs.sizes()[marker["folder"]][0] == folders
    assert requests(spark, tmp_path) == wanted(GOOD + GOOD) and runs.rejects().count() == 6


def test_lakes_without_runs_are_read_as_before(spark, tmp_path):
    records = lake.read_lake(spark, load(spark, tmp_path, GOOD).lake)
    lake.append_to_lake(records, f"{tmp_path}/plain", "status")
    assert lake.read_lake(spark, f"{tmp_path}/plain").filter(F.col("status") == 404).count() == 20
    assert Runs.at(spark, f"{tmp_path}/plain") is None
    assert Runs(spark, f"{tmp_path}/plain").rows().count() == 0
    assert pipeline("apache_web_log", spark, output_location=f"{tmp_path}/none").runs.live() == []

import gzip

import pytest

from logmill.operators.traffic import total_records
from logmill.sources.text import read_hostnames, read_log_lines, read_rejects, write_rejects


@pytest.fixture
def logs(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "access.log").write_bytes(b"one\r\ntwo\rthree\n\nlast")
    (tmp_path / "a" / "b" / "access.log").write_bytes("vier é\n".encode())
    (tmp_path / "a" / "other.txt").write_bytes(b"not read\n")
    (tmp_path / "a" / "b" / "x{1}.log").write_bytes(b"braces\n")
    (tmp_path / "a" / "b" / "y z.txt").write_bytes(b"blank\n")
    with gzip.open(tmp_path / "a" / "access.log.gz", "wt") as f:
        f.write("packed 1\npacked 2\n")
    return str(tmp_path)


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_lines_of_all_matching_files(spark, logs):
    assert values(read_log_lines(spark, logs, "access.log")) == ["", "last", "one", "three", "two", "vier é"]
    assert values(read_log_lines(spark, logs, "*.gz")) == ["packed 1", "packed 2"]
    assert read_log_lines(spark, logs, "access*").count() == 8
    assert read_log_lines(spark, logs, "access*", partitions=3).count() == 8


def test_glob_details(spark, logs):
    assert values(read_log_lines(spark, logs, "x{1}.log")) == ["braces"]
    assert values(read_log_lines(spark, logs, "[!a]*.log")) == ["braces"]
    assert values(read_log_lines(spark, logs, "? z.txt")) == ["blank"]
    assert values(read_log_lines(spark, logs, r"x\{1}.log")) == []
    assert values(read_log_lines(spark, logs, "b/access.log")) == ["vier é"]
    assert values(read_log_lines(spark, logs, "a/?/access.log")) == ["vier é"]
    assert values(read_log_lines(spark, logs, "c/access.log")) == []


def test_hostnames(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_text('client,hostname,extra\n1.1.1.1,a,1\n2.2.2.2,,2\n3.3.3.3,"x ""q"" y",3\n4.4.4.4,NA,4\n55,"",5\n')
    rows = [tuple(r) for r in read_hostnames(spark, str(path)).orderBy("client").collect()]
    assert rows == [("1.1.1.1", "a"), ("2.2.2.2", ""), ("3.3.3.3", 'x "q" y'), ("4.4.4.4", "NA"), ("55", "")]


def test_short_row_is_an_error(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_text("client,hostname,extra\n1.1.1.1,a,1\n2.2.2.2\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_hostnames(spark, str(path)).collect()


def test_rejects_append(spark, lines, tmp_path):
    path = str(tmp_path / "errors" / "lines")
    write_rejects(lines("bad line", "", "x\ty"), path)
    write_rejects(lines("another"), path)
    assert values(read_rejects(spark, path)) == ["", "another", "bad line", "x\ty"]
    assert total_records(read_rejects(spark, path)).first()[0] == 4

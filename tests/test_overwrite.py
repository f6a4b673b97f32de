"""Exchanging a table, and outputs of the report on demand."""

import pytest
from pyspark.sql import functions as F

from logmill.plans.report import report
from logmill.sources.text import read_log_lines
from logmill.sources.warehouse import create_table


@pytest.mark.parametrize("placed", [False, True])
def test_failed_overwrite_keeps_the_table(spark, tmp_path, placed):
    name, path = f"kept_{placed}", f"{tmp_path}/t" if placed else None
    create_table(spark.range(5), name, path=path)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        create_table(bad, name, "overwrite", path)
    assert spark.table(name).count() == 5
    create_table(spark.range(7), name, "overwrite", path)
    create_table(spark.table(name).union(spark.range(1)), name, "overwrite", path)
    assert spark.table(name).count() == 8
    assert spark.sql(f"SHOW TABLES LIKE '{name}_new*'").count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_report_builds_what_is_asked_for(spark, tmp_path):
    create_table(spark.range(2), "not_a_log")
    outputs = report(spark, f"{tmp_path}/none", "not_a_log")
    assert "moving_avg" in outputs and len(outputs) == 9
    assert outputs["describe"].count() == 1
    spark.sql("DROP TABLE not_a_log")


@pytest.mark.parametrize("pattern", ["200[12]/a.log", "my logs/a.log", "logs/a.log", "*/a.log", "**/a.log", "a*.log", "a+b/?.log"])
def test_folder_patterns_as_rglob(spark, tmp_path, pattern):
    root = tmp_path / "logs"
    for name in ("2001/a.log", "2003/a.log", "my logs/a.log", "logs/a.log", "a.log", "a+b/a.log"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(name)
    got = sorted(r[0] for r in read_log_lines(spark, str(root), pattern).collect())
    assert got == sorted(p.read_text() for p in root.rglob(pattern))


def test_names_that_are_never_read(spark, tmp_path):
    with pytest.raises(ValueError, match="never read"):
        read_log_lines(spark, str(tmp_path), "_logs/a.log")

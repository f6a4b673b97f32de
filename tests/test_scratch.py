from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logmill.functions.scratch import materialize, scratch_path


def test_scratch_is_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_materialized_table_is_read_from_files(spark):
    numbers = spark.range(10).selectExpr("id", "timestamp_ntz'2019-01-22' as t")
    df, seen = materialize(numbers, "numbers", F.sum("id").alias("total"))
    assert seen == {"total": 45}
    assert sorted(df.collect()) == sorted(numbers.collect())
    assert df.dtypes == numbers.dtypes and df.inputFiles()


def test_discard(spark):
    from logmill.functions.scratch import discard, materialize
    from logmill.sources.store import Store

    kept, told = materialize(spark.range(5), "kept")
    gone, _ = materialize(kept, "gone")
    store = Store(spark, kept._scratch)
    discard(gone, spark.range(2))
    assert not store.exists(gone._scratch) and kept.count() == 5


def _files(df):
    return len([f for f in df.inputFiles() if "part-" in f])


def _dealt_out(spark, setting):
    setting("spark.sql.shuffle.partitions", "64")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return spark.range(2000).selectExpr("id % 1000 as k").groupBy("k").count()


def test_small_tables_are_few_files(spark, setting):
    """64 partitions made 64 files, for each of which executors started three processes."""
    stored, seen = materialize(_dealt_out(spark, setting), "counts", F.count("*").alias("n"), F.sum("k").alias("total"))
    assert _files(stored) <= 2 * spark.sparkContext.defaultParallelism
    assert seen == {"n": 1000, "total": 499500}
    assert sorted(stored.collect()) == [(n, 2) for n in range(1000)]


def test_large_tables_keep_their_partitions(spark, setting, monkeypatch):
    monkeypatch.setattr("logmill.functions.scratch.FILE_BYTES", 100)  # of 16,000 bytes
    assert _files(materialize(_dealt_out(spark, setting), "counts")[0]) == 64


def test_one_file_for_a_part(spark):
    """Each part had a checksum file beside it, for which executors started one more process."""
    stored, _ = materialize(spark.range(100, numPartitions=3), "parts")
    folder = Path(stored._scratch.removeprefix("file:"))
    assert sorted(f.suffix for f in folder.iterdir()) == ["", ".parquet", ".parquet", ".parquet"]
    assert stored.count() == 100


def test_damaged_files_are_noticed(spark):
    text = "a text that is kept as it stands " * 20
    stored, _ = materialize(spark.range(1, numPartitions=1).select(F.lit(text).alias("text")), "damaged")
    assert [r["text"] for r in stored.collect()] == [text]
    (part,) = Path(stored._scratch.removeprefix("file:")).glob("part-*")
    whole = part.read_bytes()
    at = whole.index(b"stands")
    part.write_bytes(whole[:at] + b"S" + whole[at + 1 :])
    with pytest.raises(Exception, match="(?i)checksum|crc"):
        stored.collect()

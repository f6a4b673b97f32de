import pytest

from logmill.functions.scratch import scratch_path
from logmill.llm import lines, stages


@pytest.mark.parametrize("stage", ["line_dedup", "repeated_passages"])
def test_small_results_come_in_few_partitions(spark, setting, stage):
    """A stage's result had all partitions of its last shuffle, so the pipeline wrote a file for each."""
    setting("spark.sql.shuffle.partitions", "32")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(n, f"a line of its own, number {n}\na line that many documents have\nword{n}", 1) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4)
    path = scratch_path(spark, "docs")
    docs.write.parquet(path)
    found = getattr(stages, stage)(spark, spark.read.parquet(path), "")
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert len(texts) == 40
    if stage == "line_dedup":
        assert sum("many documents" in t for t in texts.values()) == 1


def test_log_of_lines_is_few_files(spark, setting, monkeypatch):
    """A batch's references came in a file for each task of the scan, however little it held."""
    rows = [(n, f"a line of its own, number {n}\na line that many documents have") for n in range(64)]
    path = scratch_path(spark, "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(32).write.parquet(path)
    monkeypatch.setattr("logmill.functions.scratch.FILE_BYTES", 100)
    setting("spark.sql.files.openCostInBytes", "4096")
    setting("spark.sql.files.maxPartitionBytes", "4096")
    docs = spark.read.parquet(path)
    assert docs.rdd.getNumPartitions() == 32
    index = lines.LineIndex(spark).insert_in_batches(docs, 2)
    assert len(index.log.inputFiles()) <= 2 * 2 * spark.sparkContext.defaultParallelism
    assert index.log.count() == 128
    kept = {r["doc"]: r["n_dropped"] for r in index.apply(docs).collect()}
    assert kept == {n: 1 for n in range(63)} | {63: 0}

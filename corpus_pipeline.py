"""The corpus pipeline: documents through the operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logmill.llm import stages

#: (name, function); each function takes (spark, docs, sf_dir). What it returns is written
#: as Parquet and read again as the next one's docs.
STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("packing", stages.pack),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.run(spark, sf_dir, STAGES)

"""The Parquet lake."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logmill.functions.settings import OPEN_FILES, settings
from logmill.schema import LOG_SCHEMA, MAYBE_EMPTY
from logmill.sources.runs import OUTCOME, RECORDS, Runs


def conform(df: DataFrame) -> DataFrame:
    """The lake's columns, order and types; an error if they do not fit."""
    return df.to(LOG_SCHEMA)


def append_to_lake(df: DataFrame, path: str, partition_by: str | Sequence[str] = ()) -> None:
    """Append records, optionally in ``key=value`` folders."""
    _append(conform(df), path, [], lake_fields(partition_by))


def write_outcomes(df: DataFrame, path: str, partition_by: str | Sequence[str] = ()) -> None:
    """As ``append_to_lake``, below a first level of folders by the text column ``outcome``."""
    schema = T.StructType([T.StructField(OUTCOME, T.StringType()), *LOG_SCHEMA])
    with settings(df.sparkSession, OPEN_FILES):
        _append(df.to(schema), path, [OUTCOME], lake_fields(partition_by))


def append_in_chunks(df: DataFrame, path: str, rows: int = 100_000) -> DataFrame:
    """Append records in files of at most ``rows`` rows and return the lake."""
    conform(df).write.mode("append").option("maxRecordsPerFile", rows).parquet(path)
    return read_lake(df.sparkSession, path)


def read_lake(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """All records under ``path``, of every run; ``key=value`` folders give their column.

    Where ``path`` has folders by ``outcome``, only records are read, not rejects, and where
    runs are committed there (``sources.runs``), only what counts of them. ``recursive`` also
    reads plain nested folders, and then takes no column from folder names.
    """
    if not recursive and (found := Runs.at(spark, path)):
        return found[0].rows().select(*LOG_SCHEMA.names)
    lake = spark.read.schema(LOG_SCHEMA).parquet(path, recursiveFileLookup=recursive)
    if OUTCOME in lake.columns:
        lake = lake.filter(F.col(OUTCOME) == RECORDS)
    return lake.select(*LOG_SCHEMA.names)


def read_value_partitioned(spark: SparkSession, path: str, fields: str | Sequence[str]) -> DataFrame:
    """Records in folders named by bare values (``/404/part-0.parquet``), one level per field.

    A filter on such a field reads only the matching files.
    """
    fields = lake_fields(fields)
    stored = LOG_SCHEMA.names
    schema = T.StructType([f for f in LOG_SCHEMA if f.name not in fields])
    files = spark.read.schema(schema).parquet(path, recursiveFileLookup=True)
    values = {}
    for level, f in enumerate(fields):
        below = F.substring_index("_metadata.file_path", "/", level - len(fields) - 1)
        values[f] = _folder_value(F.substring_index(below, "/", 1)).cast(LOG_SCHEMA[f].dataType)
    return files.select(*[values[c].alias(c) if c in values else F.col(c) for c in stored])


def _folder_value(segment: Column) -> Column:
    """A folder name as a value: the path itself is URL-encoded, and names may be so once more."""
    name = F.url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.when(segment.contains("%"), decoded).otherwise(segment)


def repartition_lake(spark: SparkSession, source: str, target: str, field: str) -> DataFrame:
    """Rewrite a lake in folders by ``field`` into a new folder, and return it.

    ``target`` must not exist yet.
    """
    (field,) = lake_fields(field)
    records = read_lake(spark, source).hint("rebalance", field)
    records.write.mode("errorifexists").partitionBy(field).parquet(target)
    return read_lake(spark, target)


def _append(records: DataFrame, path: str, folders: list[str], fields: list[str]) -> None:
    """Partitioned writes ask AQE to gather each key and to cut a large one into
    several files of even size, so a hot key neither lands in one task nor leaves
    one small file per task."""
    if fields:
        records = records.hint("rebalance", *fields)
    records.write.mode("append").partitionBy(*folders, *fields).parquet(path)


def lake_fields(fields: str | Sequence[str]) -> list[str]:
    """One or several field names as a list, refused if they cannot be folders."""
    names = [fields] if isinstance(fields, str) else list(fields)
    for name in names:
        if name not in LOG_SCHEMA.names:
            raise ValueError(f"no such field: {name}")
        if name in MAYBE_EMPTY:
            raise ValueError(f"{name} can be empty text, which a partition folder cannot hold")
    return names

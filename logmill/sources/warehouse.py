"""Catalog tables."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def create_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> DataFrame:
    """Store ``df`` as table ``name``; by default an existing table is an error.

    ``path`` puts the files there instead of in the warehouse folder. ``overwrite`` writes
    new files beside the old ones (below ``path``, in a folder of their own) and exchanges
    the tables when they are complete: if the job fails, the old table is still there.
    """
    spark = df.sparkSession
    if mode != "overwrite" or not spark.catalog.tableExists(name):
        writer = df.write.mode(mode).format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return spark.table(name)
    new = f"{name}_new_{uuid4().hex}"
    try:
        create_table(df, new, path=f"{path.rstrip('/')}/{new}" if path else None)
    except Exception:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": new})
        raise
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(name)}")
    return spark.table(name)


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("DESCRIBE IDENTIFIER(:name)", {"name": name})

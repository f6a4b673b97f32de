"""SQL names for reports written as text."""

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Add ``strftime(time, '%H')`` to the session, for SQL over the warehouse table.

    A SQL function: Spark replaces the call by its body when it plans the query.
    Other formats are an error; Spark's own ``date_format`` has them.
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION strftime(time TIMESTAMP_NTZ, format STRING) RETURNS STRING
        RETURN CASE format WHEN '%H' THEN lpad(CAST(hour(time) AS STRING), 2, '0')
          ELSE raise_error('strftime knows only the format %H, not ' || format) END
    """)

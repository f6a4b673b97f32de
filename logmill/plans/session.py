"""Session settings of the job."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Cut hot join partitions and rebalanced keys at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Piece size of those cuts; the default of 64 MB makes small lake files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Text shrinks about tenfold in the lake: larger splits keep its files from being tiny.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Records and rejects stay open side by side in one write, which saves sorting by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def session(app_name: str = "logmill", shuffle_partitions: int | None = None) -> SparkSession:
    """``shuffle_partitions`` should be about one per 200 MB of joined records, because
    AQE merges small partitions but cuts only those far above the median."""
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

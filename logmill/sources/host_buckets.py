"""The lake's records by host, for joins that leave them where they are.

A catalog table with a partition for each run and a fixed number of buckets, which the catalog
records. A record is dealt out once, when its run is added; each later join of the table to a host
name list shuffles the list only.

A host with many records would make one bucket large, and a bucket is one task of the join. So
such a host is cut into pieces: its records are dealt to buckets by host and piece, and in the join
its name is there once for each piece. Which hosts are cut, and into how many pieces, is kept beside.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.functions.scratch import materialize
from logmill.functions.settings import PARTITION_BYTES, estimated_bytes, settings
from logmill.schema import JOINED_COLUMNS
from logmill.sources.runs import RUN, Runs
from logmill.sources.warehouse import quoted

#: What the warehouse table needs of a record.
COLUMNS = [c for c in JOINED_COLUMNS if c != "hostname"]
_TYPES = {"datetime": "TIMESTAMP_NTZ", "status": "BIGINT", "bytes": "BIGINT"}


class HostBuckets:
    """The table ``name``, which need not exist yet; ``path`` puts its files there.

    ``buckets`` holds for a new table: by default as many as give each about 128 MB of the first
    records. A table that is there keeps its number.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.hot_name = spark, name, f"{name}_hot"
        self.path = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}").rstrip("/")
        self._wanted = buckets

    def buckets(self) -> int | None:
        """The recorded number of buckets; None if there is no table."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        told = self.spark.sql(f"DESCRIBE EXTENDED {quoted(self.name)}").filter("col_name = 'Num Buckets'").first()
        return int(told["data_type"])

    def runs(self) -> set[str]:
        """The run folders whose records the table holds."""
        return {r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {quoted(self.name)}").collect()}

    def sync(self, runs: Runs) -> dict[str, int]:
        """Add the lake's runs that the table lacks and drop those that don't count any more.

        A run's partitions are written aside and put in place whole, so one that was killed is
        written again.
        """
        live = [m["folder"] for m in runs.live()]
        count = self.buckets() or self._create(runs.rows(folders=live))
        held = self.runs()
        missing = [folder for folder in live if folder not in held]
        if missing:
            self._add(runs.rows(folders=missing).select(*COLUMNS, RUN), count)
            for folder in missing:  # one without records has no files
                self._alter("ADD IF NOT EXISTS", folder)
        for folder in held - set(live):
            self._alter("DROP IF EXISTS", folder)
        return {"added": len(missing), "runs": len(live)}

    def _alter(self, what: str, folder: str) -> None:
        self.spark.sql(f"ALTER TABLE {quoted(self.name)} {what} PARTITION ({RUN} = '{folder}')")

    def _create(self, records: DataFrame) -> int:
        count = self._wanted or max(1, -(-estimated_bytes(records.select(*COLUMNS)) // PARTITION_BYTES))
        columns = ", ".join(f"{c} {_TYPES.get(c, 'STRING')}" for c in COLUMNS)
        hot = f"{self.path}.hot"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(self.hot_name)} (host STRING, pieces INT) USING parquet LOCATION '{hot}'")
        self.spark.sql(
            f"CREATE TABLE {quoted(self.name)} ({columns}, piece INT, {RUN} STRING) USING parquet "
            f"PARTITIONED BY ({RUN}) CLUSTERED BY (host, piece) SORTED BY (host, piece) INTO {count} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        return count

    def _add(self, records: DataFrame, count: int) -> None:
        """Hosts with more than an even share of a bucket are cut, each piece being at most that.

        At most twice as many pieces as buckets come of it, so their list is small whatever the table.
        """
        hosts = records.groupBy("host").count()
        total = records.count()
        share = max(1, -(-total // count))
        hot = hosts.filter(F.col("count") > share)
        hot = hot.select("host", F.ceil(F.col("count") / share).cast("int").alias("pieces"))
        hot, _ = materialize(hot, "hot-hosts")
        hot.write.mode("append").insertInto(self.hot_name)  # before the records that need it
        piece = F.pmod(F.xxhash64("datetime", "request", "bytes", F.monotonically_increasing_id()), F.col("pieces"))
        cut = records.join(F.broadcast(hot), "host", "left").withColumn("piece", F.coalesce(piece, F.lit(0)).cast("int"))
        with settings(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            # the buckets' own hash, so that each bucket is one file of one task
            dealt = cut.repartition(count, "host", "piece").select(*COLUMNS, "piece", RUN)
            dealt.write.insertInto(self.name, overwrite=True)

    def joined(self, names: DataFrame, folders: list[str]) -> DataFrame:
        """The left join of the runs in ``folders`` to a host name list: warehouse columns and ``run``."""
        logs = self.spark.table(self.name).filter(F.col(RUN).isin(folders))
        hot = self.spark.table(self.hot_name).groupBy("host").agg(F.max("pieces").alias("pieces"))
        pieces = F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)
        spread = names.join(hot, F.col("client") == F.col("host"), "left")
        spread = spread.select("client", "hostname", F.explode(pieces).alias("of_piece"))
        same = (logs["host"] == spread["client"]) & (logs["piece"] == spread["of_piece"])
        return logs.join(spread, same, "left").select(*JOINED_COLUMNS, RUN)

    def drop(self) -> None:
        for name in (self.name, self.hot_name):
            self.spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")

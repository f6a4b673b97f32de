"""Ingest as a chain of steps: extract, clean, lake, transform, warehouse.

Every load to the lake is a run with a name (``sources.runs``). Given the name of a run that is
committed, the load changes nothing; one that was killed is done again under its name. With
``new_files_only`` a run reads the files that no committed run has read.

In table mode ``"runs"`` the warehouse table grows by runs (``sources.run_table``); with ``buckets``
the records are also kept by host, and no join shuffles them again (``sources.host_buckets``).
"""

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logmill.functions.settings import shuffled_by_size
from logmill.operators.clean import clean
from logmill.operators.enrich import join_hostnames
from logmill.operators.parse import split_lines
from logmill.schema import LOG_SCHEMA
from logmill.sources.files import list_files, new_files, read_files
from logmill.sources.host_buckets import HostBuckets
from logmill.sources.lake import lake_fields, read_lake, write_outcomes
from logmill.sources.run_table import RunTable
from logmill.sources.runs import OUTCOME, RECORDS, REJECTS, RUN, Runs
from logmill.sources.text import export_rejects, read_hostnames
from logmill.sources.warehouse import create_table


class LogPipeline:
    """Log files to a lake, its rejects and a warehouse table.

    Steps return the pipeline, so they chain. ``extract_log`` lists files; only
    ``load_to_data_lake`` and ``load_datawarehouse`` read them.

    The rejects are in the lake, in the run that met them: ``Runs.rejects`` is a view of them.
    With ``errors_location`` they are also put there as text, a folder for each run, made from
    what is committed: if a crash keeps it from being made, the run's next load makes it.
    """

    def __init__(
        self,
        spark: SparkSession,
        output_location: str = "output",
        errors_location: str | None = None,
        table: str = "joined_log_table",
        partition_field: str | Sequence[str] = (),
        offset_mode: str = "reference",
        on_bad_value: str = "fail",
        table_mode: str = "errorifexists",
        table_path: str | None = None,
        run: str | None = None,
        new_files_only: bool = False,
        on_changed: str = "fail",
        buckets: int | None = None,
    ):
        if on_bad_value not in ("fail", "reject"):
            raise ValueError(f"on_bad_value must be 'fail' or 'reject', not {on_bad_value!r}")
        self.spark = spark
        self.output_location = output_location.rstrip("/")
        self.errors_location = errors_location.rstrip("/") if errors_location else None
        self.table = table
        self.partition_field = partition_field
        self.offset_mode = offset_mode
        self.on_bad_value = on_bad_value
        self.table_mode = table_mode
        self.table_path = table_path
        self.run = run or f"{datetime.now(timezone.utc):%Y-%m-%d}-{uuid4()}"
        self.new_files_only = new_files_only
        self.on_changed = on_changed
        self.buckets = buckets
        self.runs = Runs(spark, self.output_location)
        self._listing = self.runs.new_folder(self.run)
        self.files: DataFrame | None = None
        self.unread: list[str] = []
        self.hostname_csv: str | None = None
        self.records: DataFrame | None = None
        self.names: DataFrame | None = None
        self.stored: DataFrame | None = None
        self.joined: DataFrame | None = None
        self.counts: dict[str, int] = {}

    @property
    def lake(self) -> str:
        """Folder of the cleaned records of all runs, for ``read_lake``."""
        return self.output_location

    def extract_log(
        self, directory: str, file_pattern: str, hostname_csv: str | None, partitions: int | None = None
    ) -> "LogPipeline":
        """Log files below ``directory``; ``partitions`` spreads the lines of a few large ``.gz`` files.

        The list of files is taken once and kept with the run, before they are read.
        """
        self.hostname_csv = hostname_csv
        if self.runs.find(self.run):  # committed: nothing to read
            self.records = split_lines(read_files(self.spark, []))
            return self
        listed = list_files(self.spark, directory, file_pattern)
        found = listed.files
        if self.new_files_only:
            found = new_files(found, self.runs.seen_files(), self.on_changed)
        self.files, self.unread = self.runs.write_files(found, self._listing), listed.unread
        paths = [r["path"] for r in self.files.select("path").collect()]
        return self.extract_lines(read_files(self.spark, paths, partitions), hostname_csv)

    def extract_lines(self, lines: DataFrame, hostname_csv: str | None = None) -> "LogPipeline":
        """As ``extract_log``, for lines already in a DataFrame with a column ``value``."""
        self.hostname_csv = hostname_csv
        self.records = split_lines(lines)
        return self

    def clean_log_record(self) -> "LogPipeline":
        if self.records is None:
            raise ValueError("nothing to clean: call extract_log first")
        on_bad_value = "fail" if self.on_bad_value == "fail" else "null"
        self.records = clean(self.records, self.offset_mode, on_bad_value)
        return self

    def load_to_data_lake(self) -> "LogPipeline":
        """Add this run to the lake, records and rejects.

        One pass over the log files: good records and rejects go to two folders of one write, in
        a folder of this attempt. A reject keeps its line in ``user_agent``, so both have the
        lake's schema. The run counts once it is committed, and only one attempt at it can be.
        A run of new files is not committed if another one has read one of them meanwhile.
        """
        if self.records is None:
            raise ValueError("nothing to load: call extract_log first")
        done = self.runs.find(self.run) or self._load()
        self.counts = {"records": done["records"], "rejects": done["rejects"]}
        if done["unread"]:
            self.counts["unread"] = done["unread"]
        self._export(done["folder"])
        return self

    def _load(self) -> dict:
        good = F.col("host").isNotNull()
        if self.on_bad_value == "reject":
            good &= F.col("bytes").isNotNull() & F.col("status").isNotNull() & F.col("datetime").isNotNull()
        seen = Observation()
        counted = [F.count_if("good").alias("records"), F.count_if(~F.col("good")).alias("rejects")]
        marked = self.records.withColumn("good", good).observe(seen, *counted)
        outcome = F.when(F.col("good"), F.lit(RECORDS)).otherwise(F.lit(REJECTS)).alias(OUTCOME)
        names = [c for c in LOG_SCHEMA.names if c != "user_agent"]
        fields = [F.when(F.col("good"), F.col(c)).alias(c) for c in names]
        line = F.when(F.col("good"), F.col("user_agent")).otherwise(F.col("value")).alias("user_agent")
        by = lake_fields(self.partition_field)
        folder = self.runs.new_folder(self.run)
        write_outcomes(marked.select(outcome, *fields, line), self.runs.place(folder), by)
        if self.new_files_only and self.files is not None:
            twice = self.files.join(self.runs.seen_files(), ["path", "modified", "length"], "left_semi")
            if not twice.isEmpty():
                raise RuntimeError(f"another run has read the same files in the meantime: {twice.first()['path']}")
        listing = self._listing if self.files is not None else None
        return self.runs.commit(self.run, folder, **seen.get, listing=listing, fields=by, unread=self.unread, replaces=[])

    def _export(self, folder: str) -> None:
        """The run's rejects as text, unless they are there whole."""
        if self.errors_location is None:
            return
        place = f"{self.errors_location}/run={folder}"
        if not self.runs.store.exists(f"{place}/_SUCCESS"):
            export_rejects(self.runs.rejects([folder]), place)

    def transform_data(self) -> "LogPipeline":
        """Join the whole lake, not just this run, to the host names."""
        if self.hostname_csv is None:
            raise ValueError("no host name file: give one to extract_log")
        self.names = read_hostnames(self.spark, self.hostname_csv)
        self.stored = read_lake(self.spark, self.lake)
        self.joined = join_hostnames(self.stored, self.names)
        return self

    def load_datawarehouse(self) -> "LogPipeline":
        """Store the table: whole, or in mode ``"runs"`` the runs that it doesn't have yet."""
        if self.joined is None:
            raise ValueError("nothing to store: call transform_data first")
        if self.table_mode != "runs":
            with shuffled_by_size(self.stored):
                create_table(self.joined, self.table, self.table_mode, self.table_path)
            return self
        table = RunTable(self.spark, self.table, self.table_path)
        with shuffled_by_size(self.stored):
            self.counts |= table.update(self.runs, self.names, self._joined_runs())
        return self

    def _joined_runs(self) -> Callable[[list[str]], DataFrame]:
        """How runs are joined: from the lake, or from its copy in buckets, which is brought up to date."""
        if not self.buckets:
            return lambda folders: join_hostnames(self.runs.rows(folders=folders), self.names, RUN)
        place = f"{self.table_path}.by_host" if self.table_path else None
        by_host = HostBuckets(self.spark, f"{self.table}_by_host", place, self.buckets)
        by_host.sync(self.runs)
        return lambda folders: by_host.joined(self.names, folders)


_KINDS = {"apache_web_log": LogPipeline}


def pipeline(kind: str, spark: SparkSession, **options) -> LogPipeline:
    """The pipeline for a type of log."""
    if kind not in _KINDS:
        raise ValueError(f"unknown pipeline type {kind!r}, known: {sorted(_KINDS)}")
    return _KINDS[kind](spark, **options)

"""Runs of a lake: what each wrote, and which of it counts.

An attempt at a run writes its records and its rejects below a folder of its own, in one write,

    <lake>/run=<run>~<attempt>/outcome=log/...       records
    <lake>/run=<run>~<attempt>/outcome=reject/...    lines that are no log lines

and then puts one small file, its marker, to ``<lake>/_runs/commits/<run>.json``. The marker is the
commit: it is there whole or not at all, and there is one at most for each run. What an attempt
wrote that never got its marker (the job was killed, or another attempt was faster) is not read.
So a run that is repeated under its name changes nothing, and one that was killed is just run again.

The files that a run has read are kept, too (``<lake>/_runs/files/``), so that a later run can
read only what is new.

Small files of many runs are rewritten into few by a run of its own, whose marker names the folders
that it replaces. That file, too, is the whole exchange.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logmill.functions.settings import OPEN_FILES, settings
from logmill.schema import FILES_SCHEMA, LOG_SCHEMA
from logmill.sources.store import Store

OUTCOME, RECORDS, REJECTS, RUN = "outcome", "log", "reject", "run"
MARKER_SCHEMA = (
    "run string, folder string, committed string, records bigint, rejects bigint, listing string, "
    "fields array<string>, unread array<string>, replaces array<string>"
)
_SMALL = 0.5  # of the wanted size: files that are this small on average are rewritten


class Runs:
    """The runs of the lake at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.store = Store(spark, self.path)
        self._commits = f"{self.path}/_runs/commits"

    @staticmethod
    def at(spark: SparkSession, path: str) -> tuple[Runs, tuple[str, ...]] | None:
        """The runs that ``path`` belongs to, a lake's folder or that of one outcome in it, and
        which outcomes it holds; None where no run was ever committed."""
        path, outcomes = path.rstrip("/"), (RECORDS, REJECTS)
        above, _, name = path.rpartition("/")
        if name in (f"{OUTCOME}={RECORDS}", f"{OUTCOME}={REJECTS}"):
            path, outcomes = above, (name.partition("=")[2],)
        runs = Runs(spark, path)
        return (runs, outcomes) if runs.store.exists(runs._commits) else None

    # -- one run -----------------------------------------------------------------------------

    def new_folder(self, run: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
            raise ValueError(f"a run's name has letters, digits and . _ - only, and starts with one of the first two: {run!r}")
        return f"{run}~{uuid4().hex[:12]}"

    def place(self, folder: str) -> str:
        return f"{self.path}/{RUN}={folder}"

    def write_files(self, files: DataFrame, listing: str) -> DataFrame:
        """Keep the list of files that a run is to read, and return it as it is kept."""
        place = f"{self.path}/_runs/files/{listing}"
        files.write.parquet(place)
        return self.spark.read.schema(FILES_SCHEMA).parquet(place)

    def commit(self, run: str, folder: str, **told) -> dict:
        """Make ``folder`` the run's result and return its marker; if the run has one, return that."""
        marker = {"run": run, "folder": folder, "committed": f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%S.%f}", **told}
        if self.store.create_once(f"{self._commits}/{run}.json", json.dumps(marker) + "\n"):
            return marker
        return self.find(run)

    def find(self, run: str) -> dict | None:
        """The marker of a run."""
        place = f"{self._commits}/{run}.json"
        if not self.store.exists(place):
            return None
        return self.spark.read.schema(MARKER_SCHEMA).json(place).first().asDict()

    # -- all runs ----------------------------------------------------------------------------

    def markers(self) -> list[dict]:
        """All markers, in order of commit."""
        if not self.store.exists(self._commits):
            return []
        found = self.spark.read.schema(MARKER_SCHEMA).json(self._commits).collect()
        return sorted((m.asDict() for m in found), key=lambda m: (m["committed"], m["run"]))

    def live(self) -> list[dict]:
        """Markers of the folders to be read. ``origins``: the runs' folders whose rows it holds.

        A rewrite whose folders are not all there any more (another one was faster) is void.
        """
        live: dict[str, dict] = {}
        for marker, origins in self.history():
            for folder in marker["replaces"] or ():
                del live[folder]
            live[marker["folder"]] = marker | {"origins": origins}
        return list(live.values())

    def history(self) -> list[tuple[dict, set[str]]]:
        """All markers that are not void, also those replaced later, with their origins."""
        live: set[str] = set()
        origins: dict[str, set[str]] = {}
        found = []
        for marker in self.markers():
            old = marker["replaces"] or []
            if not live.issuperset(old):
                continue
            origins[marker["folder"]] = {o for folder in old for o in origins[folder]} or {marker["folder"]}
            live = (live - set(old)) | {marker["folder"]}
            found.append((marker, origins[marker["folder"]]))
        return found

    def seen_files(self) -> DataFrame:
        """The files that committed runs have read."""
        read = [f"{self.path}/_runs/files/{m['listing']}" for m in self.markers() if m["listing"]]
        if not read:
            return self.spark.createDataFrame([], FILES_SCHEMA)
        return self.spark.read.schema(FILES_SCHEMA).parquet(*read)

    def rows(self, outcomes: Iterable[str] = (RECORDS,), folders: Iterable[str] | None = None) -> DataFrame:
        """What committed runs wrote, or those in ``folders``, with ``outcome`` and ``run`` (the folder).

        Only the folders that count are listed and read.
        """
        some = None if folders is None else set(folders)
        counts = {RECORDS: "records", REJECTS: "rejects"}
        schema = T.StructType([*LOG_SCHEMA, T.StructField(OUTCOME, T.StringType()), T.StructField(RUN, T.StringType())])
        places: dict[tuple, list[str]] = {}  # by the fields that have folders, which may change from run to run
        for m in self.live():
            if some is None or m["folder"] in some:
                own = [f"{self.place(m['folder'])}/{OUTCOME}={o}" for o in outcomes if m[counts[o]]]
                places.setdefault(tuple(m["fields"] or ()), []).extend(own)
        read = self.spark.read.schema(schema).option("basePath", self.path)
        parts = [read.parquet(*own).select(*schema.names) for own in places.values() if own]
        return reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], schema)

    def rejects(self, folders: Iterable[str] | None = None) -> DataFrame:
        """The rejected lines, as column ``value``."""
        return self.rows((REJECTS,), folders).select(F.col("user_agent").alias("value"))

    def create_view(self, name: str = "rejects") -> DataFrame:
        """The rejected lines under a name for SQL, for this session."""
        lines = self.rejects()
        lines.createOrReplaceTempView(name)
        return lines

    # -- upkeep ------------------------------------------------------------------------------

    def compact(self, target_bytes: int = 128 << 20) -> dict | None:
        """Rewrite the folders whose files are small into files of about ``target_bytes``, and
        return the marker; None if there is nothing to gain.

        Spark's scan packs small files into tasks of the wanted size, and each task writes what it
        reads: no shuffle. Lakes in folders by fields are dealt out by them, a large one cut into
        several files. Readers see the old folders until the marker is there, the new one after;
        a job that fails leaves all as it was.
        """
        sizes = self.sizes()
        small = [m for m in self.live() if _mean(*sizes.get(m["folder"], (0, 0))) < _SMALL * target_bytes]
        small = [m for m in small if m["folder"] in sizes]
        if sum(sizes[m["folder"]][0] for m in small) < 2:
            return None
        run = f"compact-{datetime.now(timezone.utc):%Y-%m-%d}-{uuid4().hex}"
        folder = self.new_folder(run)
        fields = sorted({f for m in small for f in m["fields"] or ()})
        rows = self.rows((RECORDS, REJECTS), [m["folder"] for m in small])
        packed = {
            "spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        }
        with settings(self.spark, packed | OPEN_FILES):
            rows = rows.hint("rebalance", *fields) if fields else rows
            rows.drop(RUN).write.partitionBy(OUTCOME, *fields).parquet(self.place(folder))
        told = {k: sum(m[k] for m in small) for k in ("records", "rejects")}
        return self.commit(run, folder, **told, listing=None, fields=fields, unread=[], replaces=[m["folder"] for m in small])

    def clean_up(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete folders that don't count (of killed or replaced runs) and haven't changed for so long."""
        live = {m["folder"] for m in self.live()}
        listings = {m["listing"] for m in self.markers()}
        before = (datetime.now(timezone.utc).timestamp() - 3600 * older_than_hours) * 1000
        gone = []
        for name, changed in self.store.folders(self.path):
            if name.startswith(f"{RUN}=") and name[len(RUN) + 1 :] not in live and changed <= before:
                gone.append(f"{self.path}/{name}")
        for name, changed in self.store.folders(f"{self.path}/_runs/files"):
            if name not in listings and changed <= before:
                gone.append(f"{self.path}/_runs/files/{name}")
        for place in gone:
            self.store.delete(place)
        return gone

    def sizes(self) -> dict[str, tuple[int, int]]:
        """How many data files each folder has, and their bytes; Spark lists them."""
        files = self.spark.read.format("binaryFile").load(self.path, recursiveFileLookup=True, pathGlobFilter="*.parquet")
        folder = F.regexp_extract("path", rf"/{RUN}=([^/]+)/", 1).alias("folder")
        told = files.select(folder, "length").groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
        return {r["folder"]: (r["n"], r["bytes"]) for r in told.collect()}


def _mean(files: int, size: int) -> float:
    return size / files if files else 0.0

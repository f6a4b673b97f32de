"""Log files as a table: which there are, and which are new."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.schema import FILES_SCHEMA
from logmill.sources.store import Store
from logmill.sources.text import folder_filter, folder_regex, glob_regex, name_glob

#: What to do about a file that an earlier run has read and that has changed since.
ON_CHANGED = ("fail", "read", "skip")

#: What Spark and Hadoop put beside files that they write.
_NOT_LOGS = ("_SUCCESS", "_temporary")


@dataclass
class Listing:
    """``files``: path, modified, length; ``unread``: paths that match but that Spark can't read."""

    files: DataFrame
    unread: list[str]


def list_files(spark: SparkSession, directory: str, file_pattern: str) -> Listing:
    """Every file under ``directory``, at any depth, that matches ``file_pattern``, as
    ``text.read_log_lines`` has it, and in addition files in folders whose names start with ``_`` or ``.``.

    Spark lists files without opening them, and skips such names. The store is asked for them
    apart: what lies in such a folder can be read by its path. A file whose own name starts so
    can't; it is told in ``unread``.
    """
    *folders, name = file_pattern.split("/")
    files = spark.read.format("binaryFile").load(directory, recursiveFileLookup=True, pathGlobFilter=name_glob(name))
    store = Store(spark, directory)
    found = files.select("path", F.col("modificationTime").alias("modified"), "length")
    hidden, unread = [], []
    for place, is_folder in store.hidden(directory):
        if place.rpartition("/")[2] in _NOT_LOGS:
            continue
        for path, time, length in store.files(place) if is_folder else ((place, 0, 0),):
            own = path.rpartition("/")[2]
            if not _matches(own, name):
                continue
            if own.startswith(("_", ".")):
                unread.append(path)
            else:
                hidden.append((path, datetime.fromtimestamp(time / 1000, timezone.utc), length))
    if hidden:
        found = found.unionByName(spark.createDataFrame(hidden, FILES_SCHEMA))
    if folders:
        found = found.filter(folder_filter(F.col("path"), store.plain(directory), folders, encoded=False))
        unread = [p for p in unread if _in_folders(p, store.plain(directory), folders)]
    return Listing(found, sorted(unread))


def new_files(listed: DataFrame, seen: DataFrame, on_changed: str = "fail") -> DataFrame:
    """The files of ``listed`` that ``seen`` doesn't have: an anti-join on path, time and length.

    A file that ``seen`` has with another time or length has changed: ``"fail"`` stops the job
    with its name, ``"read"`` has it read again, whole, ``"skip"`` leaves it.
    """
    if on_changed not in ON_CHANGED:
        raise ValueError(f"on_changed must be one of {ON_CHANGED}, not {on_changed!r}")
    new = listed.join(seen, ["path", "modified", "length"], "left_anti")
    if on_changed == "read":
        return new
    known = seen.select("path").distinct().withColumn("known", F.lit(True))
    marked = new.join(known, "path", "left")
    if on_changed == "skip":
        return marked.filter("known IS NULL").drop("known")
    stop = F.raise_error(F.concat(F.lit("a log file has changed since it was read: "), "path"))
    return marked.withColumn("path", F.when(F.col("known"), stop).otherwise(F.col("path"))).drop("known")


def read_files(spark: SparkSession, paths: list[str], partitions: int | None = None) -> DataFrame:
    """One row ``value`` per line of the files; as ``text.read_log_lines``."""
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]  # no globs
    lines = spark.read.text(plain) if plain else spark.createDataFrame([], "value string")
    return lines.repartition(partitions) if partitions else lines


def _matches(own: str, pattern: str) -> bool:
    return re.fullmatch(glob_regex(pattern), own) is not None


def _in_folders(path: str, root: str, folders: list[str]) -> bool:
    below = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)[len(root) + 1 :]
    return re.match(f"^(?:[^/]+/)*{folder_regex(folders)}[^/]*$", below) is not None

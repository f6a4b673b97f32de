"""Log files and the host name list."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.sources.runs import Runs
from logmill.sources.store import Store


def read_log_lines(
    spark: SparkSession, directory: str, file_pattern: str, partitions: int | None = None
) -> DataFrame:
    """One row ``value`` per line of every file under ``directory``, at any depth,
    whose name matches the glob ``file_pattern``.

    ``.gz`` files are unpacked by their suffix. One such file is one task;
    ``partitions`` spreads the lines again after reading, for a few large ones.
    A pattern with ``/`` also fixes the folders right above the file, below ``directory``;
    ``**`` stands for any number of them. Spark skips files and folders whose names
    start with ``_`` or ``.``, so a pattern that asks for such a name is an error.
    """
    *folders, name = file_pattern.split("/")
    if any(part.startswith(("_", ".")) for part in (*folders, name)):
        raise ValueError(f"names that start with _ or . are never read: {file_pattern!r}")
    lines = spark.read.text(directory, recursiveFileLookup=True, pathGlobFilter=name_glob(name))
    if folders:
        root = Store(spark, directory).plain(directory)
        lines = lines.filter(folder_filter(F.col("_metadata.file_path"), root, folders))
    lines = lines.select("value")
    return lines.repartition(partitions) if partitions else lines


def read_hostnames(spark: SparkSession, path: str) -> DataFrame:
    """``client`` and ``hostname`` of a CSV with header; further columns are dropped.

    All columns are text. An empty cell is empty text, not null, so that null
    after the join means "not listed". A short row is an error.
    """
    table = spark.read.option("columnPruning", False).csv(path, header=True, escape='"', mode="FAILFAST")
    return table.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("client", "hostname")])


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Append raw lines, one per line, to the reject folder."""
    rejected.select("value").write.mode("append").text(path)


def export_rejects(rejected: DataFrame, path: str) -> None:
    """The raw lines of one run as text, in a folder of its own: made again, they are the same."""
    rejected.select("value").write.mode("overwrite").text(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines: of a folder of text, or of a lake's runs."""
    if found := Runs.at(spark, path):
        return found[0].rejects()
    return spark.read.text(path).select("value")


def name_glob(name: str) -> str:
    """A file name's glob for Spark, whose globs know alternatives in braces and escapes: plain text here."""
    return re.sub(r"([{}\\])", r"\\\1", name).replace("[!", "[^")


def folder_filter(address: Column, root: str, folders: list[str], encoded: bool = True) -> Column:
    """Whether the folders right above a file match the globs ``folders``, below ``root``."""
    below = F.substring(_plain_path(address, encoded), len(root) + 2, 1 << 30)
    return below.rlike(f"^(?:[^/]+/)*{folder_regex(folders)}[^/]*$")


def folder_regex(folders: list[str]) -> str:
    return "".join("(?:[^/]+/)*" if part == "**" else f"{glob_regex(part)}/" for part in folders)


def _plain_path(address: Column, encoded: bool = True) -> Column:
    """The path of a file's address, decoded; a plus sign stands for itself."""
    path = F.regexp_replace(address, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    if not encoded:
        return path
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def glob_regex(part: str) -> str:
    """A folder's glob as a regex: ``*``, ``?``, ``[...]`` and ``[!...]``."""
    wild = {"*": "[^/]*", "?": "[^/]"}
    out, at = "", 0
    while at < len(part):
        end = part.find("]", at + 2 + (part[at + 1 : at + 2] == "!")) if part[at] == "[" else -1
        if end > 0:
            chars = part[at + 1 : end]
            no, chars = ("^", chars[1:]) if chars[0] == "!" else ("", chars)
            out += f"[{no}" + re.sub(r"([\\\[\]^&])", r"\\\1", chars) + "]"
            at = end
        else:
            out += wild.get(part[at], re.escape(part[at]))
        at += 1
    return out

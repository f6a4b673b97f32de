"""Tables written in the middle of a query, in the cluster's shared folder."""

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from logmill.functions.settings import source_bytes
from logmill.sources.store import Store

#: Bytes of sources for which a table gets a file, and files for each core that it may have in any case.
FILE_BYTES, FILES_A_CORE = 8 << 20, 2
#: On a local file system Hadoop puts a checksum file beside each file, and starts processes for
#: both and for their folder (see ``in_few_files``). Written plainly, a file has none beside it.
#: Parquet's pages have checksums of their own, which are held against the pages instead.
#: Other file systems take no notice.
PLAIN_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
PAGE_SUMS = "parquet.page.write-checksum.enabled", "parquet.page.verify-checksum.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under ``spark.checkpoint.dir`` (or the folder set on the context).

    A private temporary folder stands in only on a local master, where driver
    and tasks share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/logmill/{name}-{uuid4().hex}"


def in_few_files(df: DataFrame, file_bytes: int | None = None) -> DataFrame:
    """``df`` in no more partitions than the size of its sources calls for, without a shuffle:
    one for ``file_bytes`` of them (as a rule, ``FILE_BYTES``).

    AQE merges small partitions where it may, and only after a shuffle. Each file costs the store
    several calls; Hadoop's local file system starts three processes for one, and until such a
    process runs its own program it counts with all memory of its executor.
    """
    wanted = -(-source_bytes(df) // (file_bytes or FILE_BYTES))
    most = max(FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism, wanted)
    return df.coalesce(min(most, 1 << 20))


def materialize(df: DataFrame, name: str, *measures: Column, file_bytes: int | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` once and read it back: later uses neither recompute it nor
    depend on the executors that made it, and the planner sees its real size.
    Small tables become few files, as by ``in_few_files``.

    Also returns ``measures``, aggregates of ``df`` taken while it is written.
    """
    path, seen = scratch_path(df.sparkSession, name), Observation()
    few = in_few_files(df, file_bytes)
    summed, verified = PAGE_SUMS
    writer = (few.observe(seen, *measures) if measures else few).write.options(**PLAIN_LOCAL).option(summed, True)
    writer.parquet(path)
    stored = df.sparkSession.read.option(verified, True).schema(df.schema).parquet(path)
    stored._scratch = path
    return stored, seen.get if measures else {}


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote, of tables that nothing reads any more. Others stay."""
    for stored in tables:
        if path := getattr(stored, "_scratch", None):
            Store(stored.sparkSession, path).delete(path)


_ROOTS: list[str] = []


def _local_root() -> str:
    if not _ROOTS:
        _ROOTS.append(tempfile.mkdtemp(prefix="logmill-"))
        atexit.register(shutil.rmtree, _ROOTS[0], ignore_errors=True)
    return _ROOTS[0]

"""Small files and folder names in the store that holds the lake, whichever it is (HDFS, object store, local)."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession


class Store:
    """The file system of ``path``. Only names and a few small files pass through the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def plain(self, path: str) -> str:
        """The path without scheme, as listings have it."""
        return self.fs.makeQualified(self._path(path)).toUri().getPath().rstrip("/")

    def qualified(self, path: str) -> str:
        return self.fs.makeQualified(self._path(path)).toString().rstrip("/")

    def create_once(self, path: str, text: str) -> bool:
        """Put a small file there, whole, unless there is one: then nothing changes and the answer is False."""
        folder, _, name = path.rpartition("/")
        new = f"{folder}/.{name}.{self._jvm.java.util.UUID.randomUUID().toString()}"
        out = self.fs.create(self._path(new), True)
        out.write(text.encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
        keep = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # without "overwrite"
        try:
            context.rename(self._path(new), self._path(path), keep)
        except Exception:
            self.fs.delete(self._path(new), False)
            if not self.exists(path):
                raise
            return False
        return True

    def make_folder(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def folders(self, path: str) -> list[tuple[str, int]]:
        """Names of the folders right below, and when each last changed (milliseconds)."""
        if not self.exists(path):
            return []
        found = self.fs.listStatus(self._path(path))
        return [(f.getPath().getName(), f.getModificationTime()) for f in found if f.isDirectory()]

    def hidden(self, path: str) -> Iterator[tuple[str, bool]]:
        """What lies below ``path`` under a name that starts with ``_`` or ``.``, at any depth: each
        such file or folder, and whether it is a folder. The store evaluates a pattern for every
        depth; only what it finds comes to the driver."""
        below = re.sub(r"([\\{}\[\]*?,])", r"\\\1", path.rstrip("/")) + "/"
        while self.fs.globStatus(self._path(below + "*")):
            for one in self.fs.globStatus(self._path(below + "[_.]*")) or ():
                yield one.getPath().toString(), one.isDirectory()
            below += "[!_.]*/"

    def files(self, path: str) -> Iterator[tuple[str, int, int]]:
        """Path, time (milliseconds) and length of every file below, hidden or not."""
        found = self.fs.listFiles(self._path(path), True)
        while found.hasNext():
            one = found.next()
            yield one.getPath().toString(), one.getModificationTime(), one.getLen()

"""Operator 13: exact duplicates by Grace hash partitioning and tables that compare whole contents.

1. Every task normalises its rows and puts them into an open-addressing table of bounded size. A
   content that it holds already is not passed on again: its row becomes a member of the earlier
   one. So a text that a third of all rows hold leaves each task once for every fill of its table.
   Contents (packed) and members are written to the shared folder, which fixes their numbers.
2. Contents are partitioned by bits of their hash, as many as their measured bytes need. A bucket
   larger than the bound is written out and partitioned again by the next bits, until each one fits
   or holds a single hash. These tables and the shuffle's files are the spill files; a lost
   executor's share is made again.
3. A bucket goes through one table as a stream: equal hashes are compared byte by byte, and only
   different contents are kept. Each content thus learns its group's size and the row that stays.
4. Members take the answer of their content: a join on (task, number), whose largest key has the
   rows of one table of one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from operator import eq

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import batched, id_and_text, materialize, rows_of, table, utf8

#: Packed bytes of contents in one bucket, and bytes of contents in the table of a reading task.
BUCKET_BYTES = 16 << 20
#: Packed bytes that one task streams through its tables.
TASK_BYTES = 64 << 20
#: Hash bits of one step of partitioning beyond the first.
STEP_BITS = 6
HASH_BITS = 63

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Table:
    """Open addressing: slots of entry numbers, linear probing, whole contents compared."""

    def __init__(self, same: Callable[[bytes, bytes], bool] = eq, slots: int = 1 << 10):
        self.slots, self.hashes, self.contents = [-1] * slots, [], []
        self.bytes, self.same = 0, same

    def place(self, hash_: int, content: bytes) -> tuple[int, bool]:
        """The entry of a content, and whether it is new."""
        if 2 * len(self.hashes) >= len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = hash_ & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hash_ and self.same(self.contents[entry], content):
                return entry, False
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(hash_)
        self.contents.append(content)
        self.bytes += len(content)
        return len(self.hashes) - 1, True

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, hash_ in enumerate(self.hashes):
            at = hash_ & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _is_after(one, other) -> bool:
    """Order of ids, a null one before all others."""
    return one is not None and (other is None or one > other)


class Groups:
    """A table whose entries count rows and know the row that stays: that of the largest id."""

    def __init__(self, same: Callable[[bytes, bytes], bool] = eq):
        self.table = Table(same)
        self.n, self.top, self.at = [], [], []

    def add(self, hash_: int, content: bytes, n: int, doc, at) -> int:
        entry, new = self.table.place(hash_, content)
        if new:
            self.n.append(n)
            self.top.append(doc)
            self.at.append(at)
        else:
            self.n[entry] += n
            if _is_after(doc, self.top[entry]):
                self.top[entry], self.at[entry] = doc, at
        return entry


def _read(rows: DataFrame, kind: str, table_bytes: int) -> DataFrame:
    """Contents (whose ``size`` is not null) and members; a member names its content by ``task, number``."""

    def make():
        task, number, seen, held = TaskContext.get().partitionId(), 0, 0, Groups()
        pack = zstandard.ZstdCompressor(level=1)

        def contents() -> Iterator[dict]:
            nonlocal held, number
            hashes, own = held.table.hashes, held.table.contents
            for a in range(0, len(own), 128):
                some = range(a, min(a + 128, len(own)))
                packed = [pack.compress(own[k]) for k in some]
                yield {
                    "task": [task] * len(some), "number": [number + k for k in some], "row": [held.at[k] for k in some],
                    "doc": [held.top[k] for k in some], "hash": [hashes[k] for k in some], "size": [len(p) for p in packed],
                    "n": [held.n[k] for k in some], "sha256": [hashlib.sha256(own[k]).hexdigest() for k in some],
                    "content": packed,
                }
            number += len(own)
            held = Groups()

        def each(batch):
            nonlocal seen
            if batch is None:
                yield from contents()
                return
            for part in rows_of(batch):
                docs, numbers = part["doc"].to_pylist(), []
                for k, (doc, text) in enumerate(zip(docs, utf8(part["text"]))):
                    content = text.translate(_LOWER)
                    hash_ = xxhash.xxh3_64_intdigest(content) >> 64 - HASH_BITS
                    numbers.append(number + held.add(hash_, content, 1, doc, seen + k))
                    if held.table.bytes > table_bytes:
                        yield from contents()
                some = len(docs)
                none = {c: pa.nulls(some, t) for c, t in _CONTENT_ONLY.items()}
                yield {"task": [task] * some, "number": numbers, "row": range(seen, seen + some), "doc": part["doc"]} | none
                seen += some

        return each

    schema = (
        f"task int, number bigint, row bigint, doc {kind}, hash bigint, size bigint, n bigint, sha256 string, content binary"
    )
    return batched(rows, schema, make, ends=True)


_CONTENT_ONLY = {"hash": pa.int64(), "size": pa.int64(), "n": pa.int64(), "sha256": pa.string(), "content": pa.binary()}


def buckets(contents: DataFrame, total: int, bucket_bytes: int) -> Iterator[DataFrame]:
    """``contents`` with their ``bucket``, in parts by the number of hash bits that their buckets have."""
    bits = min((2 * total // bucket_bytes).bit_length(), HASH_BITS)
    while True:
        contents = contents.withColumn("bucket", F.shiftright("hash", HASH_BITS - bits))
        sizes = contents.groupBy("bucket").agg(
            F.sum("size").alias("bytes"), F.min("hash").alias("first"), F.max("hash").alias("last")
        )
        large = sizes.filter((F.col("bytes") > bucket_bytes) & (F.col("first") < F.col("last"))).select("bucket")
        large, told = materialize(large, "large-buckets", F.count(F.lit(1)).alias("n"))
        if not told["n"]:
            yield contents
            return
        yield contents.join(large, "bucket", "left_anti")
        contents, _ = materialize(contents.join(large, "bucket", "left_semi").drop("bucket"), "spilled")
        bits = min(bits + STEP_BITS, HASH_BITS)


def _resolve(bucketed: DataFrame, kind: str, tasks: int) -> DataFrame:
    """``task, number, keep, keep_task, keep_row, group_size, sha256`` of each content."""

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def same(one: bytes, other: bytes) -> bool:
            """Equal packed bytes are equal contents; of others, the contents are compared."""
            return one == other or unpack(one) == unpack(other)

        bucket, held, members = None, Groups(same), []

        def answers() -> Iterator[dict]:
            nonlocal held, members
            for a in range(0, len(members), 1 << 16):
                task, number, entry, sha = zip(*members[a : a + (1 << 16)])
                at = [held.at[k] for k in entry]
                yield {
                    "task": task, "number": number, "keep": [held.top[k] for k in entry],
                    "keep_task": [x for x, _ in at], "keep_row": [x for _, x in at],
                    "group_size": [held.n[k] for k in entry], "sha256": sha,
                }
            held, members = Groups(same), []

        def each(batch):
            nonlocal bucket
            if batch is None:
                yield from answers()
                return
            columns = [batch[c].to_pylist() for c in ("bucket", "task", "number", "row", "doc", "hash", "n", "sha256", "content")]
            for own, task, number, row, doc, hash_, n, sha, content in zip(*columns):
                if own != bucket:
                    yield from answers()
                    bucket = own
                members.append((task, number, held.add(hash_, content, n, doc, (task, row)), sha))

        return each

    schema = f"task int, number bigint, keep {kind}, keep_task int, keep_row bigint, group_size bigint, sha256 string"
    return batched(bucketed.repartition(tasks, "bucket").sortWithinPartitions("bucket"), schema, make, ends=True)


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``doc, keep, group_size, kept, sha256`` for each row.

    Texts are equal if they are identical after lower-casing A-Z; null is empty. Of equal texts the
    row with the largest id stays, of several with that id exactly one; a null id comes before all
    others, so a group has a null ``keep`` only if none of its rows has an id. ``sha256`` is of the
    normalised text in UTF-8. Texts are read whole, whatever their length; other columns are not
    read, whatever their names. No rows give no rows.
    """
    source = id_and_text(df, id_col, text_col)
    kind = source.schema["doc"].dataType.simpleString()
    total = F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    stored, told = materialize(_read(source, kind, bucket_bytes), "contents", total)
    # told apart by a small column, so that reading members leaves the contents alone
    contents = stored.filter(F.col("size").isNotNull())
    members = stored.filter(F.col("size").isNull()).select("task", "number", "row", "doc")
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, -(-told["bytes"] // TASK_BYTES))
    answers = None
    for part in buckets(contents, told["bytes"], bucket_bytes):
        own = _resolve(part, kind, tasks)
        answers = own if answers is None else answers.unionByName(own)
    stays = (F.col("task") == F.col("keep_task")) & (F.col("row") == F.col("keep_row"))
    return members.join(answers, ["task", "number"]).select("doc", "keep", "group_size", stays.alias("kept"), "sha256")


def op13_grace_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", F.col("sha256").alias("text_sha256")
    )

"""Operator 2: incremental, reversible line dedup.

The index of lines is exact: a log of line references (key, document, +1 or -1 as documents
come and go) and a reference-count table (key, documents, largest document) derived from
them. Beside it every shard of the key space has a cuckoo filter of the keys it holds. A
batch's lines that a filter does not know are new for sure and need no look-up in the count
table; only the others are joined with it. A key leaves its filter when its last reference
goes, which a Bloom filter could not do.

A key is a 128-bit hash of the line, stripped and with small letters. References count ids: a line
of several rows of one id counts once, in one batch or in several, and rows without an id don't count.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import batched, id_and_text, in_few_files, materialize, mix, rows_of, table, utf8

BLANK = b" \t\n\x0b\f\r"
LEAST_CHARS = 20
LEAST_DOCS = 3
#: Bytes of documents for which the log of references gets a file. It is made by a scan that holds
#: little, so its tasks can be as large as Spark's scans are by default.
LOG_BYTES = 128 << 20


class CuckooFilter:
    """Sets of 64-bit pairs as 16-bit fingerprints in buckets of four, built and probed by
    whole arrays. A full table gets a second, twice as large."""

    SLOTS = 4

    def __init__(self, expected: int = 1024):
        self.tables = [self._table(expected)]

    def _table(self, expected: int) -> np.ndarray:
        buckets = 1 << max(4, int(expected / (self.SLOTS * 0.8)).bit_length())
        return np.zeros((buckets, self.SLOTS), np.uint16)

    @staticmethod
    def _places(k1: np.ndarray, k2: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        mark = (k2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, (k1.view(np.uint64) & np.uint64(buckets - 1)).astype(np.int64)

    @staticmethod
    def _other(mark: np.ndarray, place: np.ndarray, buckets: int) -> np.ndarray:
        return place ^ (mix(mark.astype(np.uint64)) & np.uint64(buckets - 1)).astype(np.int64)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Keys that the filter doesn't hold yet (exact counts say so)."""
        while len(k1):
            own = self.tables[-1]
            space = int(own.size * 0.9) - int(np.count_nonzero(own))
            if space > 0:
                self._fill(own, *self._places(k1[:space], k2[:space], len(own)))
            k1, k2 = k1[max(space, 0) :], k2[max(space, 0) :]
            if len(k1):
                self.tables.append(self._table(max(len(k1), own.size)))

    def _fill(self, own: np.ndarray, mark: np.ndarray, place: np.ndarray) -> None:
        chance = np.random.default_rng(len(mark))
        for turn in range(2000):
            if not len(mark):
                return
            bucket, first = np.unique(place, return_index=True)
            rows, marks = own[bucket], mark[first]
            free = rows == 0
            has = free.any(1)
            own[bucket[has], free[has].argmax(1)] = marks[has]
            full = bucket[~has]
            if turn >= 8:
                slot = chance.integers(self.SLOTS, size=len(full))
                marks[~has], own[full, slot] = own[full, slot], marks[~has]
            rest = np.ones(len(mark), bool)
            rest[first] = False
            moved = marks[~has]
            place = np.concatenate([place[rest], self._other(moved, full, len(own))])
            mark = np.concatenate([mark[rest], moved])
        raise RuntimeError("cuckoo table overfull")  # loads of up to 0.9 don't get here

    def _where(self, own: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        mark, place = self._places(k1, k2, len(own))
        other = self._other(mark, place, len(own))
        return mark, place, other, (own[place] == mark[:, None]).any(1)

    def maybe(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """False: never inserted."""
        found = np.zeros(len(k1), bool)
        for own in self.tables:
            mark, _, other, here = self._where(own, k1, k2)
            found |= here | (own[other] == mark[:, None]).any(1)
        return found

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Keys that the filter holds."""
        for a, b in zip(k1.tolist(), k2.tolist()):
            key = np.array([a], np.int64), np.array([b], np.int64)
            for own in reversed(self.tables):
                mark, place, other, _ = self._where(own, *key)
                spot = next(((p, s) for p in (place[0], other[0]) for s in np.flatnonzero(own[p] == mark[0])), None)
                if spot:
                    own[spot] = 0
                    break


def line_keys(text: bytes, least_chars: int) -> list[bytes | None]:
    """The key of each line as 16 bytes, None for lines too short to count."""
    keys: list[bytes | None] = []
    for line in text.split(b"\n"):
        line = line.strip(BLANK)
        if len(line) < least_chars or not line.isascii() and len(line.decode("utf8", "replace")) < least_chars:
            keys.append(None)
        else:
            keys.append(xxhash.xxh3_128_digest(line.lower()))
    return keys


def references(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``k1, k2, doc``: each row's distinct line keys."""
    source = id_and_text(df, id_col, text_col)

    def make():
        def each(batch):
            for rows in rows_of(batch):
                keys, at = [], []
                for n, text in enumerate(utf8(rows["text"])):
                    own = {k for k in line_keys(text, least_chars) if k}
                    keys += own
                    at += [n] * len(own)
                both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield {"k1": both[:, 0], "k2": both[:, 1], "doc": rows["doc"].take(pa.array(at, pa.int64()))}

        return each

    return batched(source, f"k1 bigint, k2 bigint, doc {source.schema['doc'].dataType.simpleString()}", make)


@dataclass
class LineIndex:
    """Counts of lines over the documents inserted so far. Every change is a new set of
    written tables, so an index from before it stays valid, and ``delete`` undoes ``insert``."""

    spark: SparkSession
    keys_per_shard: int = 1 << 18
    shards: int = 0
    least_chars: int = LEAST_CHARS
    least_docs: int = LEAST_DOCS
    counts: DataFrame | None = None
    filters: DataFrame | None = None
    log: DataFrame | None = None
    docs: DataFrame | None = None

    def _shard(self) -> Column:
        return F.pmod(F.shiftright("k1", 32), F.lit(self.shards)).cast("int").alias("shard")

    def _grown(self, keys: int) -> LineIndex:
        """With shards enough for so many keys, and then no filters yet: they are made anew from the counts."""
        if self.shards and keys <= 2 * self.shards * self.keys_per_shard:
            return self
        shards = 1 << max(4, (keys // self.keys_per_shard).bit_length())
        return replace(self, shards=shards, filters=None)

    def insert_in_batches(self, df: DataFrame, batches: int, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with all documents added, in batches by a hash of their id."""
        index, of_id = self, F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(batches))
        for n in range(batches):
            index = index.insert(df.filter(of_id == n), id_col, text_col)
        return index

    def insert(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_log: bool = True) -> LineIndex:
        """The index with a batch of documents added.

        An id may come again, in this batch or in a later one: its lines are then those of all its
        rows. Without ``keep_log``, none of what the index holds can be deleted, and no id can come
        in a later batch again.
        """
        refs = references(df, id_col, text_col, self.least_chars)
        own = df.select(F.col(f"`{id_col}`").alias("doc")).filter("doc IS NOT NULL").groupBy("doc").count()
        own, told = materialize(own, "line-docs", F.max("count").alias("most"))
        if (told["most"] or 0) > 1:
            refs = refs.distinct()
        if self.docs is not None:
            again = own.join(self.docs, "doc", "left_semi").select("doc")
            if not again.isEmpty():
                if self.log is None:
                    raise ValueError("an id comes again, and the index keeps no log of references")
                refs = refs.join(self.log.join(again, "doc", "left_semi"), ["k1", "k2", "doc"], "left_anti")
        docs = own.select("doc") if self.docs is None else self.docs.union(own.select("doc")).distinct()
        if keep_log:
            refs, _ = materialize(refs, "line-refs", file_bytes=LOG_BYTES)
        return replace(self._added(refs, keep_log), docs=docs)

    def _added(self, refs: DataFrame, keep_log: bool) -> LineIndex:
        new = refs.groupBy("k1", "k2").agg(F.count("doc").alias("n"), F.max("doc").alias("last"))
        keys = F.count("*").alias("keys")
        if self.counts is None:
            counts, told = materialize(new, "line-counts", keys)
            return self._grown(told["keys"])._with(counts, counts, refs if keep_log else None)
        probed, _ = materialize(self._probed(new), "line-probed")
        old = self.counts.select("k1", "k2", F.col("n").alias("n0"), F.col("last").alias("last0"), F.lit(True).alias("known"))
        seen = probed.filter("maybe").join(old, ["k1", "k2"], "left")
        merged = seen.select(
            "k1", "k2", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"),
            F.greatest("last", "last0").alias("last"), F.coalesce("known", F.lit(False)).alias("known"),
        )
        merged, _ = materialize(merged, "line-merged")
        fresh = probed.filter("not maybe").drop("maybe").union(merged.filter("not known").drop("known"))
        kept = self.counts.join(merged.filter("known").select("k1", "k2"), ["k1", "k2"], "left_anti")
        counts = kept.select(*new.columns).union(merged.filter("known").drop("known")).union(fresh)
        counts, told = materialize(counts, "line-counts", keys)
        log = self.log.union(refs) if self.log is not None and keep_log else None
        after = self._grown(told["keys"])
        return after._with(counts, fresh if after is self else counts, log)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids (all rows that were inserted with them).
        Ids that it does not hold change nothing. Rows without an id stay."""
        if self.log is None:
            raise ValueError("the index keeps no log of references")
        gone = ids.select(F.col(f"`{id_col}`").alias("doc")).distinct()
        log, _ = materialize(self.log.join(gone, "doc", "left_anti").select("k1", "k2", "doc"), "line-refs")
        lost, _ = materialize(self.log.join(gone, "doc", "left_semi").groupBy("k1", "k2").count(), "line-lost")
        left = log.join(lost.select("k1", "k2"), ["k1", "k2"], "left_semi")
        left = left.groupBy("k1", "k2").agg(F.count("doc").alias("n"), F.max("doc").alias("last"))
        left, _ = materialize(left, "line-left")
        kept = self.counts.join(lost.select("k1", "k2"), ["k1", "k2"], "left_anti")
        counts, _ = materialize(kept.select(*left.columns).union(left), "line-counts")
        ended = lost.join(left.select("k1", "k2"), ["k1", "k2"], "left_anti")
        docs = self.docs.join(gone, "doc", "left_anti")
        return replace(self._with(counts, ended, log, drop=True), docs=docs)

    def repeated(self) -> DataFrame:
        """``k1, k2, last``: keys in enough documents, and the document that keeps them."""
        return self.counts.filter(F.col("n") >= self.least_docs).select("k1", "k2", "last")

    def apply(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None) -> DataFrame:
        """``doc, text, n_lines, n_dropped`` and ``carry``: the rows without repeated lines.

        A line goes unless its document is the last that holds it. Null and empty texts are one
        empty line. Rows with equal ids lose and keep the same lines; rows with a null id keep
        only lines that aren't repeated. The row's text is moved to its lines, not collected
        elsewhere; a line of very many documents is the skewed side of a join with one row.
        """
        refs = references(df, id_col, text_col, self.least_chars)
        hits = refs.join(self.repeated(), ["k1", "k2"]).filter(~F.col("doc").eqNullSafe(F.col("last")))
        hits = hits.groupBy(F.col("doc").alias("at")).agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))
        carry = F.lit(None).cast("int") if carry is None else carry
        rows = id_and_text(df, id_col, text_col, carry.alias("carry"))
        rows = rows.join(hits, F.col("doc").eqNullSafe(F.col("at")), "left").drop("at")
        least = self.least_chars

        def make():
            def each(batch):
                for part in rows_of(batch):
                    texts, n, dropped = [], [], []
                    for text, keys in zip(utf8(part["text"]), part["keys"].to_pylist()):
                        lines = text.split(b"\n")
                        n.append(len(lines))
                        if keys:
                            gone = {np.array([k["k1"], k["k2"]], np.int64).tobytes() for k in keys}
                            lines = [x for x, k in zip(lines, line_keys(text, least)) if k not in gone]
                        texts.append(b"\n".join(lines))
                        dropped.append(n[-1] - len(lines))
                    yield {
                        "doc": part["doc"],
                        "carry": part["carry"],
                        "text": pa.array(texts, pa.binary()).cast(pa.string()),
                        "n_lines": n,
                        "n_dropped": dropped,
                    }

            return each

        kinds = {f: rows.schema[f].dataType.simpleString() for f in ("doc", "carry")}
        return batched(
            rows, f"doc {kinds['doc']}, carry {kinds['carry']}, text string, n_lines bigint, n_dropped bigint", make
        )

    def _with(self, counts: DataFrame, keys: DataFrame, log: DataFrame | None, drop: bool = False) -> LineIndex:
        """With new counts and log, and with ``keys`` put into the filters or taken out of them."""
        return replace(self, counts=counts, filters=self._filtered(keys, drop), log=log)

    def _probed(self, new: DataFrame) -> DataFrame:
        kind = new.schema["last"].dataType.simpleString()

        def probe(frame: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            frame["maybe"] = False
            if len(state) and len(frame):
                known = pickle.loads(state["filter"].iloc[0])
                frame["maybe"] = known.maybe(frame["k1"].to_numpy(), frame["k2"].to_numpy())
            return frame.drop(columns="shard")

        pair = new.withColumn("shard", self._shard()).groupBy("shard").cogroup(self.filters.groupBy("shard"))
        return pair.applyInPandas(probe, f"k1 bigint, k2 bigint, n bigint, last {kind}, maybe boolean")

    def _filtered(self, keys: DataFrame, drop: bool) -> DataFrame:
        """Each shard's filter with these keys in it, or out of it."""
        before = self.filters
        if before is None:
            before = self.spark.createDataFrame([], "shard int, filter binary")

        def change(frame: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            own = pickle.loads(state["filter"].iloc[0]) if len(state) else CuckooFilter(len(frame))
            (own.delete if drop else own.insert)(frame["k1"].to_numpy(np.int64), frame["k2"].to_numpy(np.int64))
            shard = (frame if len(frame) else state)["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "filter": [pickle.dumps(own)]})

        pair = keys.select(self._shard(), "k1", "k2").groupBy("shard").cogroup(before.groupBy("shard"))
        filters, _ = materialize(pair.applyInPandas(change, "shard int, filter binary"), "line-filters")
        return filters


#: Batches in which the query and the pipeline insert.
BATCHES = 2


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept = LineIndex(spark).insert_in_batches(documents, BATCHES).apply(documents)
    kept = kept.select(F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
    return in_few_files(kept)

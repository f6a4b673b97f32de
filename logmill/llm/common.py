"""What the operators share: reading tables, Arrow batches, written tables in the middle of a job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.functions.scratch import in_few_files, materialize, scratch_path

__all__ = [
    "in_few_files", "materialize", "scratch_path", "table", "id_and_text", "key_of", "any_without_id", "batched", "visited",
    "rows_of", "utf8",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only what an operator needs, under its own names, so other columns can't clash."""
    return df.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"), *more)


def any_without_id(df: DataFrame, id_col: str = "doc_id") -> bool:
    return not df.filter(F.col(f"`{id_col}`").isNull()).isEmpty()


def key_of(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key that is never null, for operators that name rows by their id: ids in their order,
    then rows without one, by their text. ``key.id`` is the id again."""
    own = F.col(f"`{id_col}`")
    of_text = F.when(own.isNull(), F.xxhash64(F.col(f"`{text_col}`"))).otherwise(F.lit(0).cast("bigint"))
    return F.struct(own.isNull().alias("none"), own.alias("id"), of_text.alias("of_text"))


def batched(df: DataFrame, schema: str, make: Callable[[], Callable], ends: bool = False) -> DataFrame:
    """``make`` runs once per task; its result turns a batch into columns of ``schema``.

    With ``ends``, it is called with None after the last batch.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        each = make()
        for batch in chain(batches, [None] if ends else []):
            for columns in each(batch):
                yield pa.RecordBatch.from_arrays([_column(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind, from_pandas=False)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def by_group(df: DataFrame, keys: list[str], schema: str, each: Callable[[pa.Table], dict]) -> DataFrame:
    """``each`` on the whole rows of every group of integer ``keys``, which an external sort
    brings together; a task holds one group and one batch."""

    def make():
        held: pa.Table | None = None

        def run(batch):
            nonlocal held
            t = held if batch is None else pa.Table.from_batches([batch])
            if batch is not None and held is not None:
                t = pa.concat_tables([held, t])
            if t is None or not t.num_rows:
                return
            new = np.zeros(t.num_rows - 1, bool)
            for k in keys:
                value = t[k].to_numpy()
                new |= value[1:] != value[:-1]
            first = [0, *(np.flatnonzero(new) + 1).tolist()]
            if batch is None:
                first.append(t.num_rows)
            for a, b in zip(first, first[1:]):
                yield each(t.slice(a, b - a).combine_chunks())
            held = t.slice(first[-1])

        return run

    return batched(df.repartition(*keys).sortWithinPartitions(*keys), schema, make, ends=True)


def visited(
    blocks: DataFrame,
    visits: DataFrame,
    keys: list[str],
    schema: str,
    resident: Callable[[tuple, pa.Table], object],
    each: Callable[[object, dict], list[tuple]],
) -> DataFrame:
    """``each(block, visit)`` gives rows of ``schema`` for every row of ``visits``, which names its
    block by ``keys``; ``resident(key, rows)`` makes a block of its rows in ``blocks``.

    A block's rows come to one task, and its visits stream past: a task holds one block and one
    batch. Both sides have each other's columns by name, as far as they have them.
    """
    extra = [f for f in visits.schema if f.name not in blocks.columns]
    held = blocks.select("*", F.lit(0).alias("_visit"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    lacking = [f for f in blocks.schema if f.name not in visits.columns]
    came = visits.select("*", F.lit(1).alias("_visit"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking])
    names = [f.split()[0] for f in schema.split(", ")]
    columns = [c for c in blocks.columns if c not in keys]

    def make():
        key, rows, block = None, [], None

        def run(batch):
            nonlocal key, rows, block
            if batch is None:
                return
            t = pa.Table.from_batches([batch])
            own = list(zip(*[t[c].to_pylist() for c in keys]))
            visit = t["_visit"].to_numpy()
            cuts = [0, *[n for n in range(1, len(own)) if own[n] != own[n - 1] or visit[n] != visit[n - 1]], len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if own[a] != key:
                    key, rows, block = own[a], [], None
                part = t.slice(a, b - a)
                if not visit[a]:
                    rows.append(part.select(columns))
                    continue
                if block is None:
                    if not rows:
                        continue  # a visit to no block
                    block, rows = resident(key, pa.concat_tables(rows)), []
                for at in range(0, b - a, 1024):
                    found = [x for one in part.slice(at, 1024).to_pylist() for x in each(block, one)]
                    if found:
                        yield dict(zip(names, map(list, zip(*found))))

        return run

    usual = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.unionByName(came).repartition(usual, *keys).sortWithinPartitions(*keys, "_visit")
    return batched(dealt, schema, make, ends=True)


def rows_of(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what a task holds besides its input stays small."""
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def utf8(column: pa.Array) -> list[bytes]:
    """Each text's UTF-8 bytes, null as empty, without a detour over Python strings."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

"""Operator 3: approximate nearest neighbours by counting collisions in query-centred windows.

A block of vectors is projected on ``lines`` random lines, and each line's values are sorted.
A query opens on every line a window around its own value. The windows widen step by step
(virtual rehashing: a window is a run of the sorted array, and a vector lies in it if its
place in the array does); a vector that lies in ``collisions`` or more windows is verified by its exact inner
product. The search of a block ends once windows reach ``reach`` times the distance of the
k-th nearest vector verified: one nearer than that lies in each window with a probability that
makes too few collisions unlikely.

The largest inner product becomes the least distance by one more coordinate, which brings all
vectors to the length of the longest, and by stretching the query to the same length.

All vectors are indexed, none is dropped. A block's index is built once, by the task that holds
the block, and all queries stream past it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logmill.llm.common import materialize, table, visited

LINES = 96
COLLISIONS = 42
REACH = 0.66
WIDEN = 1.1


class Index:
    """Sorted projections of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, lines: int = LINES, seed: int = 7):
        self.ids, self.vectors, self.longest = ids, vectors, longest
        self.rank = np.empty(len(ids), np.int64)  # order of ids, for ties
        self.rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
        directions = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, lines))
        self.directions = directions
        values = np.column_stack([vectors, rest]) @ directions
        self.order = np.argsort(values, axis=0).T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, 1)
        # a vector's place in each sorted array: it lies in a window if its place does
        self.place = np.empty(self.order.shape, np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        np.put_along_axis(self.place, self.order, np.arange(len(ids), dtype=self.place.dtype)[None, :], 1)
        # room that every search uses again
        self.rows = np.empty_like(vectors)
        self.away, self.inside = np.empty_like(self.place), np.empty(self.place.shape, bool)

    def search(self, own: int, query: np.ndarray, k: int, collisions: int, reach: float, widen: float):
        """Ids and inner products of the k nearest found, best first; ``own`` is left out."""
        n, size = len(self.ids), self.longest
        centre = (query * (size / np.linalg.norm(query))) @ self.directions[:-1]
        place = self._places(centre, "left")
        near = np.unique(np.concatenate([o[max(p - 1, 0) : p + 1] for o, p in zip(self.order, place)]))
        score = np.full(n, -np.inf)
        done = np.zeros(n, bool)
        self._verify(near, query, score, done)
        score[self.ids == own] = -np.inf
        unit = np.linalg.norm(query)

        def distance() -> float:
            if k >= n:
                return np.inf
            known = score[done]
            best = np.partition(known, len(known) - k)[len(known) - k] if len(known) > k else -np.inf
            return np.sqrt(max(2 * size * (size - best / unit), 0)) if np.isfinite(best) else np.inf

        bound = distance()
        half = reach * (bound if np.isfinite(bound) else 2 * size) / widen
        while True:
            first, last = self._places(centre - half, "left"), self._places(centre + half, "right")
            kind = self.place.dtype
            # places before the window wrap around to the far end
            np.subtract(self.place, first.astype(kind)[:, None], out=self.away)
            np.less(self.away, (last - first).astype(kind)[:, None], out=self.inside)
            counts = np.add.reduce(self.inside.view(np.uint8), axis=0, dtype=np.uint8 if len(centre) < 256 else np.uint32)
            counts += ((last - first) >> 8 * kind.itemsize).sum().astype(counts.dtype)  # widths beyond the kind
            self._verify(np.flatnonzero((counts >= collisions) & ~done), query, score, done)
            score[self.ids == own] = -np.inf
            if half >= reach * distance() or (first.max() == 0 and last.min() == n):
                break
            half *= widen
        found = np.flatnonzero(np.isfinite(score))
        found = found[np.lexsort((self.rank[found], -score[found]))[:k]]
        return self.ids[found], score[found]

    def _places(self, values: np.ndarray, side: str) -> np.ndarray:
        return np.array([s.searchsorted(v, side) for s, v in zip(self.sorted, values)])

    def _verify(self, which: np.ndarray, query: np.ndarray, score: np.ndarray, done: np.ndarray) -> None:
        rows = np.take(self.vectors, which, axis=0, out=self.rows[: len(which)], mode="clip")
        score[which] = rows @ query
        done[which] = True


def nearest(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    lines: int = LINES,
    collisions: int = COLLISIONS,
    reach: float = REACH,
    widen: float = WIDEN,
    block: int = 16384,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest rows of
    ``df`` by inner product, in double precision, ties to the smaller id.

    Rows of the query's own id are no candidates. Vectors that are null, empty or zero or hold
    a null or a component that isn't finite take no part, nor do rows with a null id; vectors
    of different lengths are never compared. Of rows with equal ids and vectors one takes part;
    of equal ids with different vectors, each does. Fewer candidates than ``k`` are all found.
    """
    data, told = materialize(_clean(df, id_col, vector_col), "vectors", F.max("norm").alias("longest"), F.count("*").alias("n"))
    asked, _ = materialize(_clean(queries, id_col, vector_col), "queries")
    longest = told["longest"] or 1.0
    blocks = max(1, -(-told["n"] // block))
    kind = data.schema["id"].dataType.simpleString()

    def build(_, rows: pa.Table) -> Index:
        vectors = rows["vector"].combine_chunks()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        return Index(np.array(rows["id"].to_pylist(), object), flat, longest, lines)

    def search(index: Index, query: dict) -> list[tuple]:
        found, score = index.search(query["id"], np.array(query["vector"]), k, collisions, reach, widen)
        return [(query["id"], i, s) for i, s in zip(found.tolist(), score.tolist())]

    own = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    found = visited(
        data.select("size", own, "id", "vector"), asked.select("size", every, "id", "vector"), ["size", "block"],
        f"query_id {kind}, vec_id {kind}, score double", build, search,
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("norm", norm).filter("norm > 0")
    return rows.withColumn("size", F.size("vector")).dropDuplicates(["id", "vector"])


def op3_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0")).select(
        F.col("query_id").cast("long").alias("query_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").cast("long").alias("vec_id"), "score",
    )

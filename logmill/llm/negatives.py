"""Operator 12: hard negatives by angular triangle filtering.

Vectors become integers, so scores (inner products) are exact. Each vector's angles to a few
reference directions are stored. For a vector v, an anchor q and a direction r, the angle between
q and v lies between |qr - vr| and min(qr + vr, 2 pi - qr - vr): cosine intervals, which times both
norms, with room for rounding, bound the score. Only vectors whose interval meets the window that
is asked for get an integer score.

Vectors are dealt to blocks: by the reference direction nearest to them, a large cell cut into
several. A block is held by one task, sorted by the angle to its cell's direction; anchors stream
past it. So a window of angles is a run of the sorted block, and the other directions narrow it.
Blocks that can hold nothing for an anchor, by their least and greatest angles, are not visited.

First each anchor visits the block in which it lies, which gives a bound for its last positive, then
the blocks that can hold better ones; then, with its positives known, those that can hold negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logmill.llm.common import batched, materialize, table, visited

DIRECTIONS = 16
#: Rows, by hash of their id, from which the directions are taken. Results don't depend on them.
SAMPLE = 2048
MOST_BLOCK_ROWS, LEAST_BLOCK_ROWS, USUAL_BLOCKS = 1 << 16, 1 << 11, 64
#: Room for rounding: of a difference of angles, and of a score as a share of both norms.
ANGLE, SHARE = 4e-6, 1e-9
#: Sums of products below which these hold all of them exactly.
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}

_BLOCK = ["size", "cell", "salt"]


# -- vectors ---------------------------------------------------------------------------------


def clean(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``id, label, vector`` (integers) and ``size`` of the rows that take part, equal ones once."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), label.alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    stop = F.raise_error(F.lit("a vector component is too large for an integer")).cast("bigint")
    whole = F.transform("x", lambda x: F.when(F.abs(x) < 2.0**62 / scale, F.floor(x * float(scale))).otherwise(stop))
    return rows.select("id", "label", whole.alias("vector"), F.size("x").alias("size")).dropDuplicates(["id", "label", "vector"])


def directions(rows: DataFrame, sample: int, most: int) -> dict[int, np.ndarray]:
    """Unit vectors far from each other, for each length in a bounded sample: the first at hand,
    then always the row with the largest angle to those taken."""
    some = rows.select("size", "vector").orderBy(F.xxhash64("id", "vector"), "vector").limit(sample).collect()
    out = {}
    for size in {r["size"] for r in some if r["size"]}:
        v = np.array([r["vector"] for r in some if r["size"] == size], np.float64)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            continue
        v /= np.linalg.norm(v, axis=1)[:, None]
        taken = [0]
        nearest = v @ v[0]
        while len(taken) < most and (k := int(nearest.argmin())) not in taken and nearest[k] < 1 - 1e-9:
            taken.append(k)
            nearest = np.maximum(nearest, v @ v[k])
        out[size] = v[taken]
    return out


def _indexed(rows: DataFrame, of: dict[int, np.ndarray], kind: str, width: str) -> DataFrame:
    """Rows with a number, norm, angles to the directions of their length, and the nearest one."""

    def make():
        base, seen = TaskContext.get().partitionId() << 33, 0

        def each(batch):
            nonlocal seen
            sizes = batch["size"].to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(own))
                v = part["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), size)
                norm = np.linalg.norm(v, axis=1)
                refs = of.get(size, np.zeros((0, size)))
                cosine = (v @ refs.T) / np.where(norm, norm, 1)[:, None]
                angle = np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)
                packed = v.astype(width)
                yield {
                    "size": part["size"], "cell": angle.argmin(1) if len(refs) else np.zeros(len(own), int),
                    "row": np.arange(base + seen, base + seen + len(own)), "id": part["id"], "label": part["label"],
                    "norm": norm, "angles": list(angle), "vector": [x.tobytes() for x in packed]
                    if width != "<i8" else [x.tobytes() for x in part["vector"].flatten().to_numpy(zero_copy_only=False).reshape(len(own), size)],
                }
                seen += len(own)

        return each

    schema = f"size int, cell int, row bigint, id {kind}, label bigint, norm double, angles array<float>, vector binary"
    return batched(rows, schema, make)


# -- a block and an anchor -------------------------------------------------------------------


class Rows:
    """Rows in order of their angle to the cell's direction; angles are kept by direction."""

    def __init__(self, rank: np.ndarray, norm: np.ndarray, angles: np.ndarray, vectors: np.ndarray, cell: int | None):
        self.rank, self.norm, self.angles, self.vectors = rank, norm, angles, vectors
        self.first = None if cell is None else angles[cell].astype(np.float64)
        self.cell, self.longest = cell, float(norm.max())

    def take(self, which: np.ndarray) -> Rows:
        return Rows(self.rank[which], self.norm[which], np.ascontiguousarray(self.angles[:, which]), self.vectors[which], self.cell)

    def run(self, anchor: dict, least: float) -> slice:
        """Where the angle lets rows score ``least``."""
        both = anchor["norm"] * self.longest
        bound = least - 1 - SHARE * both
        if self.first is None or bound <= 0 or both == 0:
            return slice(0, len(self.rank))
        away = np.arccos(min(bound / both, 1.0)) + ANGLE
        return slice(*np.searchsorted(self.first, anchor["angles"][self.cell] + np.array([-away, away])))

    def greatest(self, run: slice, anchor: dict) -> np.ndarray:
        """The greatest score that the angles allow."""
        both = self.norm[run] * anchor["norm"]
        if self.first is None:
            return both * (1 + SHARE) + 1
        low = np.abs(self.angles[:, run] - anchor["near"]).max(0).astype(np.float64)
        return both * (np.cos(np.maximum(low - ANGLE, 0)) + SHARE) + 1

    def least(self, run: slice, anchor: dict) -> np.ndarray:
        """The least one."""
        both = self.norm[run] * anchor["norm"]
        if self.first is None:
            return -both * (1 + SHARE) - 1
        far = self.angles[:, run] + anchor["near"]
        high = np.minimum(far, 2 * np.pi - far).min(0).astype(np.float64)
        return both * (np.cos(np.minimum(high + ANGLE, np.pi)) - SHARE) - 1

    def scores(self, run: slice, which: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Integer scores of the rows ``which`` of a run. A run of which most is asked for isn't copied."""
        rows = self.vectors[run]
        found = (rows @ q)[which] if 2 * len(which) > len(rows) else rows[which] @ q
        return found if found.dtype == object else found.astype(np.int64)


class Block:
    """Rows of one block, all together and by label."""

    def __init__(self, cell: int, rows: pa.Table, width: str, kind: type):
        angles = np.array(rows["angles"].to_pylist(), np.float32).reshape(rows.num_rows, -1)
        self.width, self.kind = width, kind
        self.ids = np.array(rows["id"].to_pylist(), object)
        rank = np.empty(len(self.ids), np.int64)  # order of ids, for ties
        order = np.argsort(self.ids, kind="stable")
        rank[order] = np.arange(len(order))
        self.of_rank, self.same = self.ids[order], {}
        for place, own in zip(rank.tolist(), self.ids):
            self.same.setdefault(own, []).append(place)
        by = cell if angles.shape[1] else None
        order = np.arange(len(rank)) if by is None else np.argsort(angles[:, by], kind="stable")
        self.label = rows["label"].to_numpy()[order]
        packed = rows["vector"].to_pylist()
        vectors = np.stack([self.whole(packed[k]) for k in order])
        self.rows = Rows(rank[order], rows["norm"].to_numpy()[order], np.ascontiguousarray(angles[order].T), vectors, by)
        self.by_label = {int(x): self.rows.take(np.flatnonzero(self.label == x)) for x in np.unique(self.label)}

    def whole(self, packed: bytes) -> np.ndarray:
        """Integers in floats that hold every sum of products exactly, or else Python's own."""
        v = np.frombuffer(packed, self.width)
        return v.astype(self.kind) if self.kind is not object else np.array(v.tolist(), object)

    def _others(self, rank: np.ndarray, anchor: dict) -> np.ndarray:
        """Which rows don't have the anchor's id."""
        keep = np.ones(len(rank), bool)
        for own in self.same.get(anchor["id"], ()):
            keep &= rank != own
        return keep

    def positives(self, anchor: dict, k: int) -> list[tuple]:
        """The k best other rows of the anchor's label that score ``anchor['least']`` or more."""
        rows = self.by_label.get(anchor["label"])
        if rows is None:
            return []
        q, least = self.whole(anchor["vector"]), anchor["least"]
        least = -np.inf if least is None else float(least)
        run = slice(0, len(rows.rank))
        if rows.first is not None and len(rows.rank) > 8 * k:  # the nearest by angle give a bound
            near = np.argpartition(np.abs(rows.angles - anchor["near"]).max(0), 4 * k)[: 4 * k]
            near = near[self._others(rows.rank[near], anchor)]
            best = np.sort(rows.scores(run, near, q))
            least = max(least, float(best[-k])) if len(best) >= k else least
            run = rows.run(anchor, least)
        may = self._others(rows.rank[run], anchor) & (rows.greatest(run, anchor) >= least - SHARE * abs(least))
        which = np.flatnonzero(may)
        score = rows.scores(run, which, q)
        return [(self.of_rank[r], s) for r, s in _first(rows.rank[run][which], score, k)]

    def negatives(self, anchor: dict, k: int, low: int, high: int) -> list[tuple]:
        """For each positive the k best rows of other labels within ``low`` to ``high`` percent of it."""
        asked = [p for p in anchor["positives"] if p["score"] >= 0]  # a window of a score below zero is empty
        if not asked:
            return []
        least = min(p["score"] for p in asked) * low / 100
        most = max(p["score"] for p in asked) * high / 100
        rows, run = self.rows, self.rows.run(anchor, least)
        may = (self.label[run] != anchor["label"]) & (rows.greatest(run, anchor) >= least * (1 - SHARE))
        may &= rows.least(run, anchor) <= most * (1 + SHARE)
        which = np.flatnonzero(may & self._others(rows.rank[run], anchor))
        score, rank = rows.scores(run, which, self.whole(anchor["vector"])), rows.rank[run][which]
        out = []
        for p in asked:
            # Python's integers, as products with a percentage could pass 64 bits
            bounds = -(-low * p["score"] // 100), high * p["score"] // 100
            inside = np.flatnonzero((score >= bounds[0]) & (score <= bounds[1]))
            out += [(p["rank"], p["id"], p["score"], self.of_rank[r], s) for r, s in _first(rank[inside], score[inside], k)]
        return out


def _first(rank: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best, ties to the smaller id."""
    if len(rank) > 4 * k and score.dtype != object:
        last = np.partition(score, len(score) - k)[len(score) - k]
        rank, score = rank[score >= last], score[score >= last]
    order = sorted(range(len(rank)), key=lambda n: (-score[n], rank[n]))[:k]
    return [(rank[n], int(score[n])) for n in order]


def _visit(index: DataFrame, visits: DataFrame, schema: str, width: str, number: type, each_anchor) -> DataFrame:
    """``each_anchor(block, anchor)`` gives rows of ``schema`` for every visit of an anchor to a block."""

    def each(block: Block, anchor: dict) -> list[tuple]:
        anchor["angles"] = np.array(anchor["angles"], np.float64)
        anchor["near"] = anchor["angles"].astype(np.float32)[:, None]
        return [(anchor["row"], anchor["id"], *found) for found in each_anchor(block, anchor)]

    return visited(index, visits, _BLOCK, schema, lambda key, rows: Block(key[1], rows, width, number), each)


# -- all of them -----------------------------------------------------------------------------


def _blocks(index: DataFrame) -> DataFrame:
    """Each block's least and greatest angle to every direction, and its longest vector."""
    places = index.select(*_BLOCK, "norm", F.posexplode_outer("angles").alias("at", "angle"))
    ends = places.groupBy(*_BLOCK, "at").agg(F.min("angle").alias("least"), F.max("angle").alias("greatest"), F.max("norm").alias("longest"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "least", "greatest")))
    return ends.groupBy(*_BLOCK).agg(F.max("longest").alias("longest"), ordered.alias("ends"))


def _can_score(least: Column) -> Column:
    """Whether a block can hold a row that scores ``least`` with the anchor."""
    apart = F.zip_with(
        "angles", "ends", lambda q, e: F.greatest(F.coalesce(e["least"] - q, F.lit(0.0)), F.coalesce(q - e["greatest"], F.lit(0.0)), F.lit(0.0))
    )
    low = F.greatest(F.coalesce(F.array_max(apart), F.lit(0.0)) - ANGLE, F.lit(0.0))
    both = F.col("norm") * F.col("longest")
    return least.isNull() | (least <= 0) | (both * F.cos(low) + 1 + 2 * SHARE * both >= least)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block_rows: int = MOST_BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on the columns ``id`` and ``label`` that take part. Components become
    ``floor(scale * x)``. An anchor's positives are its best ``positives`` other rows of its label, by
    score, ties to the smaller id; with each go the best ``negatives`` rows of other labels that
    score between ``low`` and ``high`` percent of the positive. A positive below zero has no such row.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no
    part. Vectors of different lengths are never compared; empty ones score 0. Of equal rows one
    takes part; rows of the anchor's own id are neither its positives nor its negatives. Other
    columns are not read. A score or component beyond 64 bits stops the job. No rows give no rows.
    """
    label = F.col("label") if label is None else label
    rows = clean(df, id_col, vector_col, label.cast("bigint"), scale)
    most = F.max(F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0))).alias("most")
    rows, told = materialize(rows, "vectors", most, F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    largest = told["most"] or 0
    width = "<i2" if largest < 1 << 15 else "<i8"
    sums = largest * largest * max(told["size"] or 0, 1)
    number = next((kind for kind, most in EXACT.items() if sums < most), object)
    kind = rows.schema["id"].dataType.simpleString()
    index, _ = materialize(_indexed(rows, directions(rows, SAMPLE, DIRECTIONS), kind, width), "angles")
    block_rows = min(block_rows, max(LEAST_BLOCK_ROWS, -(-told["n"] // USUAL_BLOCKS)))
    parts = index.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    index = index.join(parts, ["size", "cell"]).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
    index, _ = materialize(index, "blocks")
    blocks, _ = materialize(_blocks(index), "block-angles")
    asked = index.filter(anchors)
    visitor = ["size", "row", "id", "label", "norm", "angles", "vector"]

    # positives: at home, then wherever a better one can be
    schema = f"anchor bigint, anchor_id {kind}, id {kind}, score bigint"
    none = F.lit(None).cast("bigint")

    def best(block: Block, anchor: dict) -> list[tuple]:
        return block.positives(anchor, positives)

    home, _ = materialize(
        _visit(index, asked.select(*_BLOCK, *visitor[1:], none.alias("least")), schema, width, number, best), "home"
    )
    bound = home.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    bound = bound.select(F.col("anchor").alias("row"), F.when(F.col("n") >= positives, F.col("last")).alias("least"))
    told_home = asked.join(bound, "row", "left").select(*visitor, "least", F.struct("cell", "salt").alias("home"))
    others = told_home.join(blocks, "size").filter((F.struct("cell", "salt") != F.col("home")) & _can_score(F.col("least")))
    away = _visit(index, others.select(*_BLOCK, *visitor[1:], "least"), schema, width, number, best)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = home.union(away).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    lists = first.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"),
        F.min(F.when(F.col("score") >= 0, F.col("score"))).alias("last"),
    )
    lists, _ = materialize(lists, "positives")

    # negatives: windows below each positive
    schema = f"anchor bigint, anchor_id {kind}, place int, positive_id {kind}, positive_score bigint, negative_id {kind}, negative_score bigint"
    windows = asked.select(*visitor).join(lists.filter("last IS NOT NULL"), "row")
    least = F.col("last") * (low / 100) * (1 - SHARE)
    visits = windows.join(blocks, "size").filter(_can_score(least)).select(*_BLOCK, *visitor[1:], "positives")
    found = _visit(index, visits, schema, width, number, lambda block, anchor: block.negatives(anchor, negatives, low, high))
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)
    longs = [F.col(c).cast("long").alias(c) for c in ("anchor_id", "positive_id", "negative_id")]
    return found.select(*longs, F.col("rank").cast("int").alias("rank"), "positive_score", "negative_score")

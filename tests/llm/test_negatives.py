"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logmill.llm import negatives


def by_force(rows, anchors, k=5, m=3):
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok[(i, label, tuple(math.floor(256 * x) for x in v))] = True
    out = []
    for i, label, q in ok:
        if not anchors(i):
            continue

        def ranked(others):
            score = [(sum(a * b for a, b in zip(q, v)), j) for j, _, v in others if j != i and len(v) == len(q)]
            return sorted(score, key=lambda x: (-x[0], x[1]))

        negative = ranked([o for o in ok if o[1] != label])
        for ps, p in ranked([o for o in ok if o[1] == label])[:k]:
            fit = [(s, j) for s, j in negative if 50 * ps <= 100 * s <= 95 * ps][:m]
            out += [(i, p, n, j, ps, s) for n, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def rows_of(kind, n=700):
    rng = np.random.default_rng(12)
    centre = rng.standard_normal((6, 12)) * 3
    rows = []
    for i in range(n):
        if kind == "scattered":
            v = rng.standard_normal(12) * 0.2
        elif kind == "grouped":
            v = centre[rng.integers(6)] + rng.standard_normal(12) * 0.3
        elif kind == "same":
            v = centre[0] if i % 3 else centre[1] * rng.integers(0, 2)
        else:  # scores past what doubles hold
            v = rng.standard_normal(12) * 2.0**20
        rows.append((i, [float(x) for x in v], int(rng.integers(4))))
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("kind", ["scattered", "grouped", "same", "large"])
def test_hard_negatives(spark, monkeypatch, kind):
    """With blocks of several sizes; ``large`` is scored by Python's integers."""
    rows = rows_of(kind)
    monkeypatch.setattr(negatives, "LEAST_BLOCK_ROWS", 40)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = sorted(tuple(r[c] for c in names) for r in got.collect())
    assert got == by_force(rows, lambda i: i % 10 == 0)
    assert len(got) > 100


def test_angles_spare_scores(monkeypatch):
    """In grouped vectors, few of a block's rows get an integer score."""
    import pyarrow as pa

    rows = [(i, v, label) for i, v, label in rows_of("grouped", 3000)]
    v = np.floor(256 * np.array([r[1] for r in rows]))
    norm = np.linalg.norm(v, axis=1)
    refs = v[[int(np.argmax(v @ v[k] / norm)) for k in range(16)]]
    refs = refs / np.linalg.norm(refs, axis=1)[:, None]
    angles = np.arccos(np.clip(v @ refs.T / norm[:, None], -1, 1))
    t = pa.table({
        "id": [r[0] for r in rows], "label": [r[2] for r in rows], "norm": norm, "angles": list(angles.astype(np.float32)),
        "vector": [x.astype("<i2").tobytes() for x in v],
    })
    block, scored = negatives.Block(0, t, "<i2", np.float64), []
    plain = negatives.Rows.scores
    monkeypatch.setattr(negatives.Rows, "scores", lambda self, r, w, q: scored.append(len(w)) or plain(self, r, w, q))
    for n in range(0, 3000, 100):
        anchor = t.slice(n, 1).to_pylist()[0] | {"least": None}
        anchor["angles"] = np.array(anchor["angles"])
        anchor["near"] = anchor["angles"].astype(np.float32)[:, None]
        block.positives(anchor, 5)
    assert sum(scored) < 0.25 * 30 * 750  # of the rows of the anchors' labels


def test_odd_rows(spark):
    """Nulls, not finite, zero and empty vectors, other lengths, repeated rows and ids, ties."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [0.4, 0.0], 2), (3, [0.4, 9.0], 2), (4, [0.4, -9.0], 3),
        (5, [0.39, 0.0], 2), (6, [1.0, 1.0], None), (None, [1.0, 0.0], 1), (7, None, 1), (8, [None, 1.0], 1), (9, [nan, 1.0], 1),
        (11, [inf, 1.0], 2), (12, [1.0], 1), (20, [0.0, 0.0], 1), (13, [0.0, 0.0], 2), (30, [], 1), (31, [], 2), (32, [], 1),
        (1, [0.25, 3.0], 1), (40, [-1.0, 0.0], 5), (41, [1.0, 0.0], 5),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cell string, row int")
    got = negatives.hard_negatives(df, F.col("id") % 10 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == by_force(rows, lambda i: i % 10 == 0)
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0).collect() == []
    with pytest.raises(Exception, match="too large"):
        negatives.hard_negatives(spark.createDataFrame([(1, [1e300], 1)], SCHEMA), F.col("id") > 0)

"""Exact duplicates against a dictionary of texts."""

import hashlib
import random
import re

import pytest

from logmill.llm import exact


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_force(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(small(text), []).append(doc)
    return {
        (doc, max(own), len(own), doc == max(own), hashlib.sha256(text.encode()).hexdigest())
        for text, own in groups.items()
        for doc in own
    }


def texts():
    rng = random.Random(13)
    pool = ["", " ", "Aa", "aA", "ÄÖ", "äö", "İ", "I", "same Text " * 50, "é" * 3000, "z" * 300_000]
    rows = [(d, rng.choice(pool)) for d in range(200)]
    rows += [(200 + d, "hot HOT"[: rng.choice([7, 7, 7, 6])]) for d in range(200)]
    rows += [(400 + d, "".join(rng.choice("abC ") for _ in range(rng.randrange(400)))) for d in range(150)]
    rows += [(550, None), (551, "Z" * 300_000), (552, "z" * 299_999 + "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket_bytes", [1, 300, 10_000, 1 << 24])
def test_exact_duplicates(spark, bucket_bytes):
    """Also with buckets that must be partitioned again and tables that are emptied often."""
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in exact.exact_duplicates(df, bucket_bytes=bucket_bytes).collect()]
    assert len(got) == len(rows) and set(got) == by_force(rows)


def test_equal_hashes_are_compared():
    """With one hash for all, only the contents tell texts apart."""
    rows = texts()
    groups = exact.Groups()
    for d, t in rows:
        groups.add(7, small(t).encode(), 1, d, d)
    assert {(top, n) for top, n in zip(groups.top, groups.n)} == {(keep, n) for _, keep, n, _, _ in by_force(rows)}


def test_large_buckets_are_partitioned_again(spark):
    rows = spark.range(4000).selectExpr("id", "xxhash64(id) & 9223372036854775807 AS hash", "100L AS size")
    rows = rows.union(spark.range(500).selectExpr("id", "12345L AS hash", "100L AS size"))
    parts = list(exact.buckets(rows, 2 * 400, 400))  # told less than there is
    assert len(parts) > 2
    assert sum(p.count() for p in parts) == 4500
    for part in parts:
        wide = part.groupBy("bucket").agg({"size": "sum", "hash": "approx_count_distinct"}).collect()
        assert all(r["sum(size)"] <= 400 or r["approx_count_distinct(hash)"] == 1 for r in wide)


def test_odd_rows(spark):
    """Null and repeated ids, ids as text, columns by names of the result, no rows."""
    rows = [(None, "A", 1), (None, "a", 2), (3, "a", 3), (3, "a", 3), (None, None, 4), (None, "", 5), (9, "b", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, task long")
    got = exact.exact_duplicates(df).collect()
    sizes = sorted((r["keep"] or 0, r["group_size"], r["kept"]) for r in got)
    assert sizes == [(0, 2, False), (0, 2, True), (3, 4, False), (3, 4, False), (3, 4, False), (3, 4, True), (9, 1, True)]
    assert {r["doc"] for r in got if r["keep"] == 3 and r["kept"]} == {3}
    assert exact.exact_duplicates(df.limit(0)).collect() == []
    named = df.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert {r["keep"] for r in exact.exact_duplicates(named).collect()} == {"3", "9", None}

"""Each operator on small rows with known results or against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import first_plan

from logmill.llm import jaccard, language, licenses, lines, neighbours, packing, passages, quality
from logmill.llm.bpe import decode, encode, encode_text, encoding, parts
from logmill.llm.common import materialize
from logmill.llm.components import components

LETTERS = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture
def odd_rows(spark):
    """Nulls, blanks, repeats, and columns whose names operators use themselves."""
    rows = [(1, None, "x", 1), (2, "", None, 2), (None, "a b", "x", 3), (4, " \n\t", "x", 4), (5, "Same text here now ok", "x", 5)]
    rows += [(6, "same TEXT here now ok", "y", 6), (6, "same TEXT here now ok", "y", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, doc string, n long")


# -- 1 ---------------------------------------------------------------------------------------


def groups_by_force(rows):
    sets = {}
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", small(text))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    top = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                same = len(sets[a] & sets[b])
                if same and 100 * same >= 80 * len(sets[a] | sets[b]):
                    top[a] = top[b] = min(top[a], top[b])
    return {d: (len(s), top[d]) for d, s in sets.items()}


@pytest.fixture(params=["as it is", "small blocks"])
def bounds(request, monkeypatch):
    """Bounds of the driver's steps lowered, so that groups are cut into blocks and sets unnamed."""
    if request.param == "small blocks":
        monkeypatch.setattr(jaccard, "BLOCK", 3)
        monkeypatch.setattr(jaccard, "NAMED", 1)
    return request.param


def test_near_duplicates(spark, bounds):
    rng = random.Random(5)
    rows = []
    for n in range(90):
        if rows and rng.random() < 0.6 and (words := (rng.choice(rows)[1] or "").split()):
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(LETTERS)
        else:
            words = [rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 3, 5, 6, 9, 14, 25, 40, 90]))]
        rows.append((n, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc: (r.n_shingles, r.component) for r in jaccard.near_duplicates(df).collect()}
    assert got == groups_by_force(rows)


def test_near_duplicates_odd_rows(odd_rows):
    got = sorted(map(tuple, jaccard.near_duplicates(odd_rows).collect()))
    assert got == [(1, 0, 1), (2, 0, 2), (4, 0, 4), (5, 1, 5), (6, 1, 5), (6, 1, 5)]
    assert jaccard.near_duplicates(odd_rows.limit(0)).collect() == []


def pairs_by_force(groups):
    """Pairs and members that a stream of groups (sig: names) has to give."""
    pairs, members = Counter(), set()
    for sig, names in groups.items():
        own = sorted(names)
        if len(own) > jaccard.FEW:
            members |= {(sig, n) for n in own}
        else:
            pairs.update((x, y) for k, x in enumerate(own) for y in own[k + 1 :])
    return pairs, members


@pytest.mark.parametrize("few, cut", [(2, 1), (2, 7), (3, 50), (12, 3), (12, 10_000)])
def test_signature_stream(monkeypatch, few, cut):
    """Groups cut anywhere by batches, with repeated rows."""
    monkeypatch.setattr(jaccard, "FEW", few)
    rng = random.Random(few + cut)
    groups = {s: {rng.randrange(10**6) for _ in range(rng.choice([1, 1, 2, 3, few, few + 1, 40]))} for s in range(80)}
    rows = sorted((s, n) for s, names in groups.items() for n in names for _ in range(rng.choice([1, 1, 3])))
    sig, name = np.array(rows, np.int64).T
    stream, pairs, members, starred = jaccard._Groups(), Counter(), set(), set()
    parts = [(sig[k : k + cut], name[k : k + cut], False) for k in range(0, len(sig), cut)]
    for part in [*parts, (sig[:0], name[:0], True)]:
        out = stream.add(*part)
        assert len(stream.sig) <= few + 1
        for a, b, shared, s in zip(*(out[c] for c in ("a", "b", "shared", "sig"))):
            if s is None:
                pairs[a, b] += shared
            else:
                members.add((s, a))
    want, want_members = pairs_by_force(groups)
    assert members == want_members
    for s in {s for s, _ in members}:  # in a large group, all are paired with the first
        own = sorted(groups[s])
        for n in own[1:]:
            pairs[own[0], n] -= 1
    assert +pairs == want and min(pairs.values(), default=0) >= 0


def test_frequent_signatures_are_spread():
    sig = np.array([5] * 100 + [6, 6, 7, -1, -1], np.int64)
    name = np.arange(105)[::-1].copy()
    rep = jaccard._spread(sig, name).to_pylist()
    assert sum(r is not None for r in rep) == 100 - jaccard.FEW - 1
    assert {r for r in rep if r is not None} == {min(name[:100])} and rep[100:] == [None] * 5


def test_names_that_sets_share():
    u, v = np.array([1, 2, 3], np.uint64), np.array([4, 5], np.uint64)
    names = jaccard.Names(frozenset({jaccard.name_of(u)}))
    assert names.both(v)[0] == names.of(v) == jaccard.name_of(v)
    assert names.both(u)[0] == names.of(u) != jaccard.name_of(u)
    assert names.both(u)[1] == jaccard.Names().both(u)[1] != jaccard.name_of(u)


def test_many_sets_of_one_signature(spark, monkeypatch):
    """A third of all sets have most words in common: large groups, spread, in several blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(9)
    base = [rng.choice(LETTERS) + str(k) for k in range(120)]
    rows = []
    for n in range(240):
        words = list(base) if n % 3 == 0 else [rng.choice(LETTERS) for _ in range(100)]
        for _ in range(rng.randrange(4) if n % 3 == 0 else 0):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(50))
        rows.append((n, " ".join(words)))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    want = components_by_force(rows)
    assert {r.doc: r.component for r in got.collect()} == want and Counter(want.values())[0] > 40


def components_by_force(rows):
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in rows)}
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {d: root(d) for d in sets}


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 15, 16, 40, 100, 700])
def test_similar_sets_share_a_signature(n):
    t, rng = jaccard.Threshold(4, 5), np.random.default_rng(n)
    for _ in range(60):
        u = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        v = u[rng.random(len(u)) > rng.random() * 0.15]
        v = np.unique(np.concatenate([v, rng.integers(0, 2**64, rng.integers(0, 1 + n // 8), dtype=np.uint64)]))
        same = len(np.intersect1d(u, v))
        if same and 5 * same >= 4 * (len(u) + len(v) - same):
            assert len(np.intersect1d(jaccard.signatures(u, t)[0], jaccard.signatures(v, t)[0]))
            assert len(np.intersect1d(jaccard.elements(u, t), jaccard.elements(v, t)))


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {100: 100, 150: 100, 200: 100}


def test_components_write_a_table_for_each_round_that_changes_links(spark, monkeypatch):
    """Links that are stars need no round, and a round joins twice, reading its links once each time."""
    written = []

    def counted(df, *rest):
        written.append(first_plan(df))
        return materialize(df, *rest)

    monkeypatch.setattr("logmill.llm.components.materialize", counted)
    stars = spark.createDataFrame([(1, 2), (1, 3), (4, 9), (3, 1)], "a long, b long")
    assert {(r.node, r.root) for r in components(stars).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (9, 4)}
    assert len(written) == 1
    chain = spark.createDataFrame([(1, 5), (5, 2)], "a long, b long")
    assert {(r.node, r.root) for r in components(chain).collect()} == {(1, 1), (2, 1), (5, 1)}
    assert len(written) == 3
    assert written[2].count("Generate explode") == 1 and "Union" not in written[2].split("Generate explode")[0]
    assert components(stars.limit(0)).count() == 0
    loops = spark.createDataFrame([(7, 7), (8, 8)], "a long, b long")
    assert components(loops).count() == 0


# -- 2 ---------------------------------------------------------------------------------------


def kept_by_force(rows):
    def key(line):
        return small(line.strip(" \t\n\x0b\f\r"))

    holders = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(d)
    out = {}
    for d, text in rows:
        own = (text or "").split("\n")
        left = [x for x in own if not (len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != d)]
        out[d] = ("\n".join(left), len(own), len(own) - len(left))
    return out


def test_lines_inserted_and_deleted(spark):
    rng = random.Random(2)
    pool = [f"A line that many documents hold, number {k}" for k in range(8)] + ["short", "", "é" * 19, "é" * 20]
    rows = [(d, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(6))) for d in range(40)]
    rows.append((40, None))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = lines.LineIndex(spark, keys_per_shard=4)
    for k in range(3):
        index = index.insert(df.filter(f"doc_id % 3 = {k}"))
    without = index.delete(df.filter("doc_id % 3 = 1").select("doc_id"))
    again = without.insert(df.filter("doc_id % 3 = 1"))
    for state, own in ((index, rows), (without, [r for r in rows if r[0] % 3 != 1]), (again, rows)):
        batch = spark.createDataFrame(own, "doc_id long, text string")
        got = {r.doc: (r.text, r.n_lines, r.n_dropped) for r in state.apply(batch).collect()}
        assert got == kept_by_force(own)


def test_lines_odd_rows(odd_rows):
    index = lines.LineIndex(odd_rows.sparkSession).insert(odd_rows)
    got = sorted((r.doc or 0, r.text, r.n_lines, r.n_dropped) for r in index.apply(odd_rows).collect())
    same = "same TEXT here now ok"
    # the two rows of id 6 are one document, so the line has two
    kept = [(5, "Same text here now ok", 1, 0), (6, same, 1, 0), (6, same, 1, 0)]
    assert got == [(0, "a b", 1, 0), (1, "", 1, 0), (2, "", 1, 0), (4, " \n\t", 2, 0), *kept]
    empty = odd_rows.limit(0)
    assert lines.LineIndex(odd_rows.sparkSession).insert_in_batches(empty, 2).apply(empty).collect() == []


def test_lines_count_ids(spark):
    """Ids that come again, in one batch and in later ones: counted once, as the SQL counts them."""
    import duckdb

    from logmill.llm.queries import ORACLE_SQL

    rng = random.Random(22)
    pool = [f"A line that many documents hold, number {k}" for k in range(25)]
    rows = [(rng.randrange(40), "\n".join(rng.sample(pool, 2) + ["own " * 6 + str(n)])) for n in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    batches = [df.filter(f"crc32(encode(text, 'utf-8')) % 3 = {k}") for k in range(3)]
    index = lines.LineIndex(spark, keys_per_shard=4)
    for batch in batches:
        index = index.insert(batch)
    again = index.delete(df.filter("doc_id < 15").select("doc_id")).insert(df.filter("doc_id < 15"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {d: (n, dropped) for d, n, dropped in con.execute(
        f"SELECT doc_id, n_lines, n_dropped FROM ({ORACLE_SQL['op2_line_dedup']})").fetchall()}
    assert sum(dropped for _, dropped in want.values()) > 10
    for state in (index, again, lines.LineIndex(spark).insert_in_batches(df, 2), lines.LineIndex(spark).insert(df, keep_log=False)):
        got = {}
        for r in state.apply(df).collect():
            n, dropped = got.get(r.doc, (0, 0))
            got[r.doc] = (n + r.n_lines, dropped + r.n_dropped)
        assert got == want
    with pytest.raises(ValueError, match="comes again"):
        lines.LineIndex(spark).insert(batches[0], keep_log=False).insert(batches[0])


def test_line_filters_are_probed(spark, monkeypatch):
    """Later batches go through the filters, and only what they may know is looked up."""
    rows = [(d, f"a line of its own, number {d}\nThe line that all of them have") for d in range(60)]
    probed = []
    plain = lines.LineIndex._probed
    monkeypatch.setattr(lines.LineIndex, "_probed", lambda self, new: probed.append(plain(self, new)) or probed[-1])
    index = lines.LineIndex(spark).insert_in_batches(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert len(probed) == 2 and index.log is not None
    assert [p.filter("maybe").count() for p in probed] == [1, 1]


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys, others = rng.integers(-(2**62), 2**62, (2, 2, 20_000))
    own = lines.CuckooFilter(10)
    own.insert(*keys)
    assert own.maybe(*keys).all() and own.maybe(*others).mean() < 0.01
    own.delete(*keys[:, :500])
    assert own.maybe(*keys[:, :500]).mean() < 0.01 and own.maybe(*keys[:, 500:]).all()


# -- 3 ---------------------------------------------------------------------------------------


def test_neighbours_recall_and_odd_vectors(spark):
    vectors = np.random.default_rng(3).standard_normal((700, 16)) * np.linspace(0.5, 2, 700)[:, None]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (None, [1.0] * 16), (1004, []), (1020, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), block=300).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(vectors[r.query_id] @ vectors[r.vec_id], abs=1e-12)
    hits = 0
    for q in range(0, 700, 20):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & set(found[q]))
    assert sorted(found) == list(range(0, 700, 20)) and hits >= 0.9 * 20 * 35
    assert neighbours.nearest(df.limit(0), df.limit(0)).collect() == []


@pytest.mark.parametrize("n, block", [(400, 16384), (3000, 1000), (9000, 4000)])
def test_neighbours_recall_by_size(spark, n, block):
    vectors = np.random.default_rng(n).standard_normal((n, 24))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    step = n // 40
    found = {}
    for r in neighbours.nearest(df, df.filter(f"vec_id % {step} = 0"), block=block).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, own in found.items():
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & own)
    assert len(found) == len(range(0, n, step)) and all(len(own) == 20 for own in found.values())
    assert hits >= 0.9 * 20 * len(found)


# -- 4 ---------------------------------------------------------------------------------------


def test_language(spark, odd_rows):
    rng = random.Random(4)
    words = {"en": ["the", "and", "of", "that", "with"], "de": ["der", "und", "nicht", "über", "schön"]}
    rows = [(k, " ".join(rng.choices(words[lang], k=30)), lang) for k, lang in enumerate(["en", "de"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    got = {r.doc: (r.lang_pred, r.score) for r in language.predict(df, model).collect()}
    assert all(got[k][0] == lang and 0.5 < got[k][1] <= 1 for k, _, lang in rows)
    odd = sorted((r.doc or 0, r.lang_pred) for r in language.predict(odd_rows, model).collect())
    assert [p == "und" for _, p in odd] == [False, True, True, True, False, False, False]
    nothing = language.predict(df, language.train(df.limit(0))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in nothing] == [("und", 0.0)]


# -- 5, 7 ------------------------------------------------------------------------------------


def test_quality_counts_and_outliers(spark):
    rng = random.Random(6)
    rows = [(k, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(rng.randrange(60, 200))), "en", "s") for k in range(300)]
    rows += [(300 + k, " ".join(rng.choice(LETTERS) * 4 + "$$$" for _ in range(100)), "en", "s") for k in range(5)]
    rows += [(400, None, None, None), (401, "a b c a b c\n \nx\nx", "en", "s"), (402, "", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc: r for r in quality.judged(df, least_rows=100).collect()}
    for d, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(windows)
        covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
        own = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[d]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(own) - len(set(own)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert all(got[k].kept for k in range(300)) and not any(got[300 + k].kept for k in range(5))
    assert quality.judged(df.limit(0)).collect() == []


def mcd_by_force(x, share):
    """Least determinant over the same starts, with sorted distances."""
    least = np.array([f[1] for f in quality.FEATURES.values()]) ** 2

    def nth(v, p):
        return np.sort(v)[max(int(np.ceil(p * len(v))) - 1, 0)]

    def far(c, s):
        return np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(s + np.diag(least)), x - c)

    def step(c, s):
        d = far(c, s)
        near = x[d <= nth(d, share)]
        return near.mean(0), np.cov(near.T, bias=True)

    def size(s):
        return np.linalg.slogdet(s + np.diag(least))[1]

    middle = np.array([nth(v, 0.5) for v in x.T])
    wide = np.array([(nth(v, 0.75) - nth(v, 0.25)) / 1.349 for v in x.T])
    with np.errstate(all="ignore"):
        alike = np.nan_to_num(np.corrcoef(np.tanh((x - middle) / np.maximum(wide, least**0.5)).T))
    np.fill_diagonal(alike, 1)
    starts = [(middle, np.diag(wide**2)), (x.mean(0), np.cov(x.T, bias=True)), (middle, alike * np.outer(wide, wide))]
    for _ in range(quality.FIRST_STEPS):
        starts = [step(*one) for one in starts]
    best = min(starts, key=lambda one: size(one[1]))
    assert all(size(best[1]) <= size(s) for _, s in starts)
    for _ in range(quality.MOST_STEPS):
        after = step(*best)
        fall, best = size(best[1]) - size(after[1]), after
        if fall < quality.FALL:
            break
    d = far(*best)
    return d / max(nth(d, 0.5) / quality.normal_cutoff(0.5), 1)


def test_quality_distances(spark):
    """Distances and verdicts of several groups against numpy, one group with a fifth of outliers,
    one too small for its own estimate, one too small to be judged."""
    rng = random.Random(55)

    def text(kind):
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9) if kind else 4)) for _ in range(rng.randrange(55, 300))]
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] += "$" * rng.randrange(3)
        if kind == 2:
            words = [w + "#%&$|" for w in words]
        return " ".join(words) + "\nsame line\nsame line" * rng.randrange(3)

    rows = [(n, text(2 if n % 5 == 0 else 1), "en", "web") for n in range(200)]
    rows += [(200 + n, text(1), "de", "web") for n in range(70)] + [(300 + n, text(0), "de", "book") for n in range(30)]
    rows += [(400 + n, text(1), None, None) for n in range(19)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = {r.doc: r for r in quality.judged(df).collect()}
    groups = {"en web": range(200), "de web": range(200, 270), "de": [*range(300, 330)], "none": range(400, 419)}
    lines_of = {n: len([x for x in t.split("\n") if x.strip()]) for n, t, *_ in rows}
    for name, ids in groups.items():
        own = [got[n] for n in ids]
        assert not any(r.base_failed for r in own)
        x = np.array([
            [np.log(r.n_words + 1), r.word_chars / r.n_words, np.log(1 + 100 * r.n_symbols / r.word_chars),
             r.n_dup_lines / lines_of[r.doc], r.n_repeat_words / r.n_words] for r in own
        ])
        want = np.zeros(len(own)) if name == "none" else mcd_by_force(x, 0.75)
        assert [r.distance for r in own] == pytest.approx(want.tolist(), rel=1e-6, abs=1e-9), name
        assert [r.kept for r in own] == (want <= quality.normal_cutoff(1e-11)).tolist()
    assert not any(got[n].kept for n in range(0, 200, 5)) and sum(got[n].kept for n in range(200)) >= 158


def test_normal_cutoff():
    """Quantiles of chi-square with five degrees, from tables."""
    for tail, want in ((0.5, 4.3515), (0.05, 11.0705), (0.001, 20.515)):
        assert quality.normal_cutoff(tail) == pytest.approx(want, abs=1e-3)
    assert 59 < quality.normal_cutoff(1e-11) < 62


def test_licenses(spark):
    rows = [
        (1, None, (0, 0, None, None, "", "")),
        (2, "Licensed under CC BY-NC 4.0", (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0")),
        (3, "cc by cc by\ncc-by x", (7, 3, 0, 4, "cc-by", "cc-by")),
        (4, "ALL RIGHTS RESERVED all rights Keserved", (6, 1, 0, 0, "reserved", "reserved")),
        (5, "license version 2.0 apache", (5, 0, None, None, "", "")),
        (6, "x\nReleased under the MIT License.", (6, 0, None, None, "", "mit")),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r[0]: tuple(r)[1:7] for r in licenses.scan(df).collect()}
    assert got == {d: want for d, _, want in rows}
    assert licenses.scan(df.limit(0)).collect() == []


def scan_by_force(text):
    """Labels and score, every template held against every place."""
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", small(text)) if x]
    labels = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in f" {' '.join(w)} "}
    best = 0.0
    for label, words, key in licenses.TEMPLATES:
        own, key = words.split(), key.split()
        at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
        for i in range(len(w)):
            if w[i : i + len(key)] == key:
                share = sum(0 <= i - at + k < len(w) and w[i - at + k] == x for k, x in enumerate(own)) / len(own)
                if share >= 0.6:
                    labels.add(label)
                    best = max(best, share)
    return ",".join(sorted(labels)), best


def test_licenses_of_files_with_several_notices(spark):
    rng = random.Random(7)
    notices = [words for _, words, _ in licenses.TEMPLATES]
    vocabulary = sorted({w for words in notices for w in words.split()})

    def worn(words):
        own = words.split()
        for _ in range(rng.randrange(5)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        return " ".join(own[rng.randrange(4) :])

    texts = [f"{a}\nx {b}" for a in notices for b in notices]
    texts += [". ".join(notices), " ".join(reversed(notices)), " ".join(vocabulary)]
    texts += [" ".join(rng.choices([worn(w) for w in notices] + LETTERS, k=rng.randrange(1, 12))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc: (r.labels, r.score) for r in licenses.scan(df).collect()}
    assert got == {d: scan_by_force(text) for d, text in enumerate(texts)}
    everything = {label for label, _, _ in licenses.TEMPLATES}
    assert everything <= set(got[len(notices) ** 2][0].split(","))


# -- 6, 8 ------------------------------------------------------------------------------------

TEXTS = ["", "a  b c\n d e \n\n f", " x y  z ", "foo's 'll baz\t qux   r s　t ü\x1c é" * 40, "word " * 9000, "a" * 30_000]


def test_packing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    df = spark.createDataFrame([(n, t) for n, t in enumerate([*TEXTS, None])], "doc_id long, text string").repartition(2)
    pieces = packing.pack(df, group_tokens=5000).collect()
    sequences = {}
    for n, t in enumerate([*TEXTS, ""]):
        ids = np.array([*known.encode(t, add_special_tokens=False).ids, 1], "<u4")
        own = sorted((p for p in pieces if p.doc == n), key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == ids.tobytes() and {p.doc_tokens for p in own} == {len(ids)}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [o for o, _ in sorted(own)] == ends[:-1]
        assert ends[-1] == 2048 or ends[-1] < 2048 and ends[-1] & (ends[-1] - 1) == 0
    assert packing.pack(df.limit(0)).collect() == []


def test_packing_of_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}x\n{end} ", f"a{end[:-1]}", f"<{end}>", f"{'word ' * 20_000}{end} and {'é ' * 70_000}{end}", *TEXTS]
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf8") as file:
        spec = json.load(file)
    token = spec["added_tokens"][0]
    spec["added_tokens"] += [token | {"id": 50257, "content": end + "x"}, token | {"id": 50258, "content": "|>"}]
    several, stripping = tmp_path / "several.json", tmp_path / "stripping.json"
    several.write_text(json.dumps(spec))
    spec["added_tokens"][0] = token | {"lstrip": True}
    stripping.write_text(json.dumps(spec))
    for file, plain in ((path, True), (str(several), True), (str(stripping), False)):
        tokens, known = packing.Tokens(file), Tokenizer.from_file(file)
        assert (tokens.codec is not None) == plain
        assert [i.tolist() for i in tokens.encode(texts)] == [known.encode(t, add_special_tokens=False).ids for t in texts]
    df = spark.createDataFrame([(0, texts[0])], "doc_id long, text string")
    assert [np.frombuffer(p.ids, "<u4").tolist() for p in packing.pack(df, capacity=8).collect()] == [[64, 220, 50256, 275], [1]]


def test_bpe(spark):
    codec = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in TEXTS:
        whole = np.array(codec.encode_ordinary(text), "<u4").tobytes()
        assert all(encode_text(text, codec, size) == whole and "".join(parts(text, size)) == text for size in (1, 7, 1000))
    df = spark.createDataFrame([(n, t) for n, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    got = {r.doc: bytes(r.decoded) for r in decode(encode(df)).collect()}
    assert got == {n: t.encode() for n, t in enumerate([*TEXTS, ""])}
    assert zlib.crc32(b"") == 0 and encode(df.limit(0)).collect() == []


# -- 9 ---------------------------------------------------------------------------------------


def spans_by_force(rows, length):
    count = Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = {j for i in range(len(b) - length + 1) if count[b[i : i + length]] > 1 for j in range(i, i + length)}
        runs = sum(j - 1 not in gone for j in gone)
        out.append((d, bytes(x for j, x in enumerate(b) if j not in gone), len(b), len(gone), runs))
    return sorted(out)


@pytest.mark.parametrize("gram, many", [(12, 8192), (20, 8192), (16, 2)])
def test_repeated_passages(spark, gram, many):
    rng = random.Random(gram)
    base = "".join(rng.choices("abcdefgh ", k=2000))
    rows = []
    for d in range(120):
        at = rng.randrange(1900)
        text = rng.choice(["".join(rng.choices("xyz", k=40)) + base[at : at + 60], "é" * rng.randrange(40), "a common passage of many texts" + "".join(rng.choices("xy", k=20)), None, ""])
        rows.append((d, text))
    rows += [(500, rows[0][1]), (500, "q" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = passages.without_repeats(df, length=24, gram=gram, many=many)
    assert sorted((r.doc, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got.collect()) == spans_by_force(rows, 24)


def test_passages_odd_rows(odd_rows):
    got = sorted((r.doc, r.n_bytes, r.n_removed) for r in passages.without_repeats(odd_rows, length=10, gram=5).collect())
    assert got == [(1, 0, 0), (2, 0, 0), (4, 3, 0), (5, 21, 12), (6, 21, 21), (6, 21, 21)]
    assert passages.without_repeats(odd_rows.limit(0)).collect() == []


def test_anchors_of_parts(monkeypatch):
    text = bytes(random.Random(1).choices(b"abc", k=5000))
    whole = passages.Anchors(40, 16).of(text)
    monkeypatch.setattr(passages, "PART", 300)
    assert all((a == b).all() for a, b in zip(whole, passages.Anchors(40, 16).of(text)))


# -- pipeline --------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80))
    rows = []
    for d in range(30):
        own = " ".join("".join(rng.choices("klmnopqrst", k=5)) for _ in range(120))
        rows.append((d, own + (f" {passage} " if d in (3, 7) else "") + f"\nThe same line in many documents {d // 5}", "en", "s", 0))
    rows += [(30, rows[10][1], "en", "s", 0), (31, "123 456", "en", None, 0), (32, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(range(30))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "repeated_passages", "packing"]
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    left = {r.doc_id: r.text for r in docs.collect()}
    assert passage not in left[3] and passage not in left[7] and "same line in many documents 1" in left[9]
    assert "same line" not in left[5]


def test_passages_of_over_fifty_words(spark, tmp_path):
    """The shortest that the stage has to find: 51 words in documents that have little else in common."""
    from logmill.llm import stages

    rng = random.Random(51)

    def prose(n, letters="klmnopqrst"):
        return " ".join("".join(rng.choices(letters, k=rng.choice([3, 4, 4, 5]))) for _ in range(n))

    shared = [prose(51, "abcdefgh") for _ in range(3)]
    rows = [(d, f"{prose(70)} {shared[d % 3]} {prose(70)}") for d in range(6)] + [(10 + d, prose(90)) for d in range(4)]
    rows.append((20, f"{prose(20)} {shared[0][:200]} {prose(20)}"))  # no passage of over 50 words
    assert all(stages.PASSAGE <= len(x) < 300 for x in shared)
    df = spark.createDataFrame([(d, t, len(t)) for d, t in rows], "doc_id long, text string, n_chars long")
    left = {r.doc_id: r.text for r in stages.repeated_passages(spark, df, str(tmp_path)).collect()}
    assert not any(x[5:-5] in left[d] for d in range(6) for x in shared)
    assert all(left[d] == t for d, t in rows if d >= 10)


def test_documents_without_id(spark, tmp_path):
    import corpus_pipeline
    from logmill.llm import stages

    rng = random.Random(10)

    def prose(n):
        return " ".join("".join(rng.choices("klmnopqrst", k=5)) for _ in range(n))

    passage, shared = prose(80), prose(120)
    rows = [(d, prose(120)) for d in range(10)] + [(10, f"{prose(60)} {passage} {prose(60)}"), (11, shared)]
    alone, twice, near = prose(120), prose(120), f"{shared} more"
    none = [alone, near, twice, twice, f"{prose(60)} {passage} {prose(60)}", twice.upper()]
    rows += [(None, t) for t in none]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert {d for d, _ in left} == {*range(12), None}
    own = [small(t) for d, t in left if d is None]
    assert {alone, twice} < set(own)
    assert len(own) == 3 and not any(passage in t for t in own)
    pieces = [p for p in corpus_pipeline.run(spark, str(tmp_path)).collect() if p.doc_id is None and p.start == 0]
    assert len(pieces) == 3

    got = jaccard.op1_ngram_jaccard(spark, str(tmp_path)).collect()
    assert sorted((r.n_shingles, r.component_id is None, r.component_id or 0) for r in got if r.doc_id is None) == sorted(
        [(116, True, 0), (117, False, 11), *[(116, True, 0)] * 3, (len(none[4].split()) - 4, True, 0)]
    )
    assert len(got) == len(rows)
    got = passages.op9_suffix_dedup(spark, str(tmp_path)).collect()
    want = sorted((d < 0, max(d, 0), hashlib.sha256(kept).hexdigest(), n, gone, runs) for d, kept, n, gone, runs in spans_by_force([(d if d is not None else -1 - k, t) for k, (d, t) in enumerate(rows)], passages.LENGTH))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept_sha256, r.n_bytes, r.n_removed, r.n_spans) for r in got) == want

    blank = spark.createDataFrame([(None, ""), (None, ""), (1, "")], "doc_id long, text string")
    assert stages.near_duplicates(spark, blank, "").count() == 3

"""Clashing columns, very long texts, ties and empty tables, for operators whose own tests don't have them."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logmill.llm import bpe, jaccard, language, licenses, lines, neighbours, packing, quality

#: Names that operators use inside.
CLASHES = (
    "doc text2 id vector size block part query rank row task number name check sig rep n n_words w l p s group start "
    "d2 cut keep ids pieces distance kept narrow own carry key k1 k2 at labels score lang_pred offset length"
).split()


def clash(df):
    return df.select("*", *[F.lit(f"{c} of the table").alias(c) for c in CLASHES if c not in df.columns])


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijkl", k=rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture
def docs(spark):
    rng = random.Random(77)
    rows = [(k, prose(rng, 80), rng.choice(["en", "de"]), "s") for k in range(40)]
    rows += [(40, rows[3][1], "en", "s"), (41, None, None, None), (42, "", "de", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def answers(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "run",
    [
        lambda d: jaccard.near_duplicates(d),
        lambda d: lines.LineIndex(d.sparkSession).insert_in_batches(d, 2).apply(d),
        lambda d: language.predict(d, language.train(d)),
        lambda d: quality.judged(d).withColumn("distance", F.round("distance", 6)),
        lambda d: packing.pack(d).drop("sequence_id", "offset"),
        lambda d: licenses.scan(d),
        lambda d: bpe.decode(bpe.encode(d)),
    ],
    ids=["op1", "op2", "op4", "op5", "op6", "op7", "op8"],
)
def test_columns_with_the_operators_own_names(docs, run):
    assert answers(run(clash(docs))) == answers(run(docs))


def test_neighbours_with_clashing_columns_and_ties(spark):
    """Equal scores go to the smaller id; names of the table don't matter."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((30, 8)).round(1)
    rows = [(k, base[k % 30].tolist()) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=6).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, neighbours.nearest(clash(df), clash(df).filter("vec_id % 20 = 0"), k=6).collect()))
    vectors = np.array([v for _, v in rows])
    for q in range(0, 120, 20):
        found = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        score = vectors @ vectors[q]
        order = sorted((k for k in range(120) if k != q), key=lambda k: (-score[k], k))
        assert [round(score[k], 9) for k in found[:3]] == [round(score[k], 9) for k in order[:3]]
        for a, b in zip(found, found[1:]):
            assert score[a] > score[b] + 1e-12 or a < b or score[a] > score[b]


def test_language_ties_and_nothing(spark):
    """Two languages learned from the same texts: equal code lengths go to the first name. A table without rows."""
    rows = [(k, text, lang) for k, (text, lang) in enumerate([("the and of that with", "xx"), ("the and of that with", "aa")] * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    balanced = df.filter(~language.held_out(F.col("doc_id")))
    n = min(r["count"] for r in balanced.groupBy("lang").count().collect())
    model = language.fit({lang: [b"the and of that with"] * n for lang in ("xx", "aa")})
    got = language.predict(df, model).select("lang_pred", "score").distinct().collect()
    assert [(r.lang_pred, round(r.score, 9)) for r in got] == [("aa", 0.5)]
    assert language.predict(df.limit(0), model).collect() == []


def ppm_by_force(texts, order=3):
    """Code length of a text in a tree of contexts, one symbol after the other (method C, no cap)."""

    def fold(text):
        out = []
        for b in text.encode():
            c = chr(b)
            out.append(b if b > 127 else ord(c.lower()) if c.isalpha() else 48 if c.isdigit() else 32 if c.isspace() or b < 32 else 46)
        return out

    known = {32, *(x for own in texts.values() for t in own for x in fold(t))}
    trees = {}
    for lang, own in texts.items():
        stream = [32] * order
        for t in own:
            stream += fold(t) + [32] * order
        tree = {}
        for k in range(order, len(stream)):
            for n in range(order + 1):
                seen = tree.setdefault(tuple(stream[k - n : k]), {})
                seen[stream[k]] = seen.get(stream[k], 0) + 1
        trees[lang] = tree

    def bits(text, tree):
        size, total = len(known) + 1, 0.0
        stream = [32] * order + [x if x in known else None for x in fold(text)] + [32] * order
        for k in range(order, len(stream)):
            p, found = 1.0, False
            for n in range(order, -1, -1):
                seen = tree.get(tuple(stream[k - n : k]))
                if not seen:
                    continue
                total_seen, kinds = sum(seen.values()), len(seen)
                if stream[k] in seen:
                    p *= seen[stream[k]] / (total_seen + kinds)
                    found = True
                    break
                p *= kinds / (total_seen + kinds)
            total -= np.log2(p if found else p / size)
        return total

    return lambda text: {lang: bits(text, tree) for lang, tree in trees.items()}


def test_language_code_lengths_by_force():
    rng = random.Random(4)
    words = {"en": "the and of that with".split(), "de": "der und nicht über schön".split(), "fr": "le où été ça 12 x-y".split()}
    texts = {lang: [" ".join(rng.choices(own, k=12)) for _ in range(9)] for lang, own in words.items()}
    model, force = language.fit(texts={k: [t.encode() for t in v] for k, v in texts.items()}), ppm_by_force(texts)
    asked = ["the über", "ça", "unknown Ж bytes", "", "x", *(rng.choice(texts[lang]) for lang in texts), prose(rng, 50)]
    got = language.code_lengths([t.encode() for t in asked], model)
    for text, row in zip(asked, got):
        want = force(text)
        assert row.tolist() == pytest.approx([want[lang] for lang in model.languages], rel=1e-4)


def test_very_long_texts(spark):
    """Some megabytes in one text: results of known parts."""
    rng = random.Random(3)
    words = [prose(rng, 1) for _ in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(300_000)) + "\nthe same line at the end of many"
    rows = [(1, long, "en", "s"), (2, long.upper(), "en", "s"), (3, "short\nthe same line at the end of many", "en", "s"), (4, "x" * 2_000_000, "en", "s")]
    rows += [(10 + k, prose(rng, 70), "en", "s") for k in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    sets = {r.doc: r for r in jaccard.near_duplicates(df).collect()}
    assert sets[1].component == sets[2].component == 1 and sets[1].n_shingles > 250_000 and sets[4].n_shingles == 1
    kept = {r.doc: (r.n_lines, r.n_dropped) for r in lines.LineIndex(spark).insert(df).apply(df).collect()}
    assert [kept[k] for k in (1, 2, 3, 4)] == [(2, 1), (2, 1), (2, 0), (1, 0)]
    told = {r.doc: r for r in quality.judged(df).collect()}
    n = len(re.findall(r"\S+", long))
    assert told[1].n_words == n == told[2].n_words and told[4].n_words == 1
    windows = {}
    own = long.split()
    for k in range(n - 2):
        windows.setdefault(tuple(own[k : k + 3]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    assert told[1].n_repeat_words == len(covered)
    model = language.fit({"en": [prose(rng, 400).encode()], "de": [b"\xc3\xbc" * 50 + b" nicht"]})
    assert {r.lang_pred for r in language.predict(df, model).collect() if r.doc < 3} == {"en"}
    scanned = licenses.scan(df.withColumn("text", F.concat("text", F.lit(" licensed under the GENERAL public-license.")))).collect()
    assert all("gpl" in r.base_labels for r in scanned) and {r.n_base for r in scanned} == {1}


def test_pipeline_stages_by_force(spark, tmp_path):
    """Each stage against plain Python on the rows of the one before, and run() against all of them."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    import public_tokenizers
    from logmill.llm import stages
    from .test_operators import groups_by_force, kept_by_force, spans_by_force

    rng = random.Random(99)
    passage, line = prose(rng, 60), "This line stands in many of the documents, " * 2
    rows = []
    for d in range(45):
        text = prose(rng, rng.choice([3, 40, 90]))
        if d % 6 == 1:
            text += f" {passage} {prose(rng, 20)}"
        if d % 4 == 2:
            text += f"\n{line}{d % 3}\nown {d}"
        if d % 9 == 5 and d > 9:
            text = rows[d - 9][1] + (" more" if d % 2 else "")
        rows.append((d, text, rng.choice(["en", "de", None]), "s", len(text)))
    rows += [(45, None, "en", "s", 0), (46, "12 34", "en", "s", 5), (47, line + "1", "de", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = {r[0]: r[1] for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = stages.materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == df.columns
        got = {r.doc_id: r.text for r in docs.collect()}
        own = sorted(before.items())
        if name == "language_id":
            want = {d: t for d, t in own if t and re.search(r"[^\W\d_]", t)}
        elif name == "line_dedup":
            want = {d: t for d, (t, *_) in kept_by_force(own).items() if t.strip()}
        elif name == "near_duplicates":
            want = {d: before[d] for d, (_, top) in groups_by_force(own).items() if d == top}
        else:
            found = {d: kept.decode("utf8", "ignore") for d, kept, *_ in spans_by_force(own, stages.PASSAGE)}
            want = {d: t for d, t in found.items() if t.strip()}
        assert got == want, name
        assert want != before, name
        assert all(r.n_chars == len(r.text) for r in docs.collect()) or name in ("language_id", "near_duplicates")
        before = want
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(before)
    for d, text in before.items():
        ids = np.array([*known.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[d], key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]] and {r.doc_tokens for r in own} == {len(ids)}
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own]

"""Token alignment against a plain form of it."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from logmill.llm import alignment

ODD = [
    None, "", " ", "  lead", "trail  ", "one  two\n\nthree\t four", "é ñ 日本語 龘 🧿🧿 ①②", "Ünïcödé wörds 𝔘𝔫𝔦",
    "<|endoftext|> <s> </s> <unk> <0x41>", "a ▁ b", "▁", "x y 　z", "a\x00b", "é ́x", "\x1c a \x85 b",
    "don't 's 12345 !!! ... ok", "word " * 400, "a,b ,c.&&& x²,½. 日本,é! (a)b<c>", ",", "x,  ", "x, ", " ,a", "a,\n.b",
]


def by_force(texts):
    """Each text as a whole: bytes of every token, owners of every byte, cuts where both end."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    out, every = [], Counter()
    for text in texts:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled_a = [bytes(byte[c] for c in a.id_to_token(t)) for t in x]
        names = [b.id_to_piece(t) for t in y]
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode() for t, p in zip(y, names)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            out.append((0, 0, 0, [], ""))
            continue
        own_a = [n for n, s in enumerate(spelled_a) for _ in s]
        own_b = [n for n, s in enumerate(spelled_b) for _ in s]
        links = [(x[m], y[n]) for m, n in sorted(set(zip(own_a, own_b)))]
        every.update(links)
        cuts = [k for k in range(1, len(whole)) if own_a[k] != own_a[k - 1] and own_b[k] != own_b[k - 1]]
        groups = []
        for first, last in zip([0, *cuts], [*cuts, len(whole)]):
            ids = [",".join(str(i[n]) for n in sorted(set(o[first:last]))) for i, o in ((x, own_a), (y, own_b))]
            groups.append("|".join(ids))
        out.append((len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, t), n in every.items():
        most[t] = max(most.get(t, 0), n)
    return [
        (na, nb, g, len(links), sum(every[p] == most[p[1]] for p in links), sum(every[p] for p in links), sha)
        for na, nb, g, links, sha in out
    ]


def texts():
    rng = random.Random(11)
    letters = "abcdeé日ß 😀\n\t'1.,"
    marks = "ab1é ²日" + alignment.MARKS
    return ODD + ["".join(rng.choice(marks) for _ in range(rng.randrange(40))) for _ in range(150)] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(150)]


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_alignment(spark, broadcast):
    rows = [(n, t) for n, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    aligned = alignment.materialize(alignment.align(df), "aligned")[0]
    found = alignment.agreement(aligned, alignment.pair_counts(aligned), broadcast)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = {r["doc"]: tuple(r[c] for c in names) for r in found.collect()}
    want = by_force([t for _, t in rows])
    assert [got[n] for n in range(len(rows))] == want
    assert sum(w[0] > 0 for w in want) > 100


def test_odd_rows(spark):
    """Nulls, repeated rows and ids, columns by names of the result."""
    rows = [(None, "a b", 1, "x"), (5, "a b", 2, "x"), (5, "a b", 2, "x"), (6, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, pairs string")
    aligned = alignment.align(df, with_groups=True)
    found = alignment.agreement(aligned, alignment.pair_counts(aligned)).collect()
    assert sorted((r["doc"] or 0, r["n_links"], r["n_best"], r["count_sum"]) for r in found) == [
        (0, 2, 2, 6), (5, 2, 2, 6), (5, 2, 2, 6), (6, 0, 0, 0),
    ]
    assert {r["groups"] for r in found if r["doc"] == 6} == {""}
    none = alignment.align(df.limit(0))
    assert alignment.agreement(none, alignment.pair_counts(none)).collect() == []


def test_long_text_and_forgetting():
    """Parts are forgotten and aligned again; a text without a safe cut is aligned as one."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    long = [" ".join(words), "".join(words), "é" * 5000, " ".join(rng.choice(words) for _ in range(40_000))]
    aligned = alignment.Aligner(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE), remembered=50)
    got = [alignment._of_text(aligned, t, p) for t in long for p in aligned.known([t])]
    for found, want in zip(got, (alignment._of_text(aligned, t, aligned._align([" " + t])) for t in long)):
        assert found == want
    assert len(aligned.new) + len(aligned.old) < 10_000

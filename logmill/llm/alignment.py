"""Operator 11: alignment of two tokenizers' tokens, and how often their ids meet in the corpus.

A is a byte-level BPE of ``tokenizers``, B a ``sentencepiece`` model. Their spans give coarse
cuts: A's character offsets, as bytes, and B's spans of the text. A token whose span ends inside
a character (one of several tokens of a multibyte character, or of several byte-fallback pieces)
has its end refined by the bytes that it decodes to. Two lists of ends then merge in one walk:
every step is a link, every common end closes a group.

Neither tokenizer lets a token reach across the left edge of a blank between two characters that
are no white space, or that of a mark after a letter or number: A's pattern starts a match there,
and B has no piece with a blank after another character, or with such a mark after a letter or
number (looked up in its vocabulary: marks that it has so are not cut at, and a model with such
blanks is aligned text by text). So texts are cut there, and a task aligns each different part once
while it remembers it; the memory is bounded. New parts are put together again, some hundred at a
time, to be encoded and aligned by few calls.

The links of each document are stored once, as its different id pairs and their numbers. Pair
counts are an aggregate over them with a partial step. Each document's links then meet the counts
in a join: a broadcast one if the counts, measured, are small, a shuffled one otherwise.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import batched, id_and_text, materialize, rows_of, table
from logmill.llm.packing import _byte_of_char

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLANK = "▁"
#: Aligned parts that a Python worker remembers, in each of two generations.
REMEMBERED = 1 << 17
#: New parts that are encoded as one string.
TOGETHER = 128
#: Pairs (24 bytes each in memory) up to which the counts go to every executor.
BROADCAST_PAIRS = 2_000_000

#: Marks before which texts may be cut, and a part that others can follow.
MARKS = ",.;:!?&$%#*|<>()[]{}/=+~^"
CARRIER = " a"
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>\Z")

#: What is known of a part: tokens of A and B, groups, links, groups as text, links as packed ids.
Part = tuple[int, int, int, int, str, bytes]


class Aligner:
    """Both tokenizers and the parts that they have aligned."""

    def __init__(self, a_file: str, b_file: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte = _byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        spelled = {n: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, n in vocabulary.items()}
        self.a_bytes = [spelled.get(n, b"") for n in range(max(spelled) + 1)]
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [_piece_bytes(p) for p in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        size = max(len(self.a_bytes), len(self.b_bytes))
        #: Every id as text, within a group, before the bar and at a group's end.
        self.written = [f"{n}{mark}" for mark in ",|;" for n in range(size)]
        self.in_parts = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        inside = {y for n, p in enumerate(pieces) if not self.b.is_byte(n) for x, y in zip(p, p[1:]) if x.isalnum()}
        self.marks = "".join(m for m in MARKS if m not in inside)
        marks = re.escape(self.marks) or "^\\s\\S"  # or none
        # from one place to cut to the next
        self._part = re.compile(
            rf"(?:(?<=\S) (?=\S)|(?<=[^\W_])[{marks}]|^.)(?:[^ {re.escape(MARKS)}]++|(?!(?<=\S) (?=\S))(?!(?<=[^\W_])[{marks}]).)*+", re.S
        )
        self.remembered = remembered
        self.new: dict[str, Part | None] = {}
        self.old: dict[str, Part | None] = {}

    def parts(self, text: str) -> list[str]:
        """The text, with the blank before it, in parts that both tokenizers take apart from each other."""
        # the mark of a blank, in a text, could join the blank after it
        return self._part.findall(" " + text) if self.in_parts and BLANK not in text else [" " + text]

    def known(self, texts: list[str]) -> list[list[Part | None]]:
        """What is known of each text's parts, after aligning those that are new."""
        cut = [self.parts(t) for t in texts]
        missing = []
        for part in dict.fromkeys(chain.from_iterable(cut)):
            if part not in self.new:
                if part in self.old:
                    self.new[part] = self.old[part]
                else:
                    missing.append(part)
        for at in range(0, len(missing), 1 << 14):
            some = missing[at : at + (1 << 14)]
            self.new.update(zip(some, self._align(some)))
        found = [list(map(self.new.__getitem__, own)) for own in cut]
        if len(self.new) > self.remembered:
            self.old, self.new = self.new, {}
        return found

    def _align(self, parts: list[str]) -> list[Part | None]:
        """None for a part that the tokens of A or of B don't spell."""
        found: dict[str, Part | None] = {}
        together = [p for p in parts if self.in_parts and not (p[1:2].isspace() or p[-1].isspace() or BLANK in p)]
        self._find(together, TOGETHER, found)
        self._find([p for p in parts if found.get(p) is None], 1, found)
        return [found.get(p) for p in parts]

    def _find(self, parts: list[str], together: int, found: dict[str, Part | None]) -> None:
        """What is known of parts, so many of them encoded as one string."""
        strings = []
        for at in range(0, len(parts), together):
            own = parts[at : at + together]
            strings.append(own if own[0][0] == " " else [CARRIER, *own])
        strings = [[q for p, o in zip(own, [" ", *own]) for q in self._after(o, p)] for own in strings]
        texts = ["".join(own) for own in strings]
        if texts:
            a = self.a.encode_batch(texts, add_special_tokens=False)
            for own, text, x, y in zip(strings, texts, a, _protos(self.b, [t[1:] for t in texts])):
                found.update(zip(own, self._merge(own, text, x, y) or ()))

    @staticmethod
    def _after(before: str, part: str) -> tuple[str, ...]:
        """A part that starts with a mark stands after a letter or number."""
        return (part,) if part[0] == " " or before[-1].isalnum() else (CARRIER, part)

    def _merge(self, parts: list[str], text: str, encoding, proto) -> list[Part] | None:
        """What is known of each part of a text; None where its tokens don't spell it."""
        whole = text.encode()
        a = encoding.ids
        b, ends = zip(*[(p.id, p.end) for p in proto.pieces]) if proto.pieces else ((), ())
        if any(b"".join(map(spelled.__getitem__, ids)) != whole for spelled, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        a_ids, b_ids = np.array(a), np.array(b)
        spans = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        # the span of a token that ends inside a character overlaps the next one's
        clean, cuts = spans[:, 1] <= np.append(spans[1:, 0], len(text)), spans[:, 1]
        if len(whole) > len(text):
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            cuts = np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))[cuts]
        a_ends = _refine(cuts, clean, self.a_sizes[a_ids])
        # B's spans don't count the blank put before the text; those inside a character are empty
        cuts = np.array(ends)
        b_ends = _refine(cuts + 1, np.diff(cuts, prepend=0) > 0, self.b_sizes[b_ids])

        # one step of the walk for every end of either: the tokens that hold the bytes before it
        steps = np.union1d(a_ends, b_ends)
        i, j = a_ends.searchsorted(steps), b_ends.searchsorted(steps)
        packed = (a_ids[i] << 32 | b_ids[j]).tobytes()
        closes = np.flatnonzero((a_ends[i] == steps) & (b_ends[j] == steps))
        # A's tokens of a group, then B's, each with the mark that follows it
        marked, size = [], len(self.written) // 3
        for ids, token_ends, mark in ((a_ids, a_ends, 1), (b_ids, b_ends, 2)):
            group = steps[closes].searchsorted(token_ends)
            last = np.diff(group, append=len(closes)) > 0
            marked.append((2 * group + mark, ids + np.where(last, mark * size, 0)))
        place, ids = (np.concatenate(x) for x in zip(*marked))
        written = list(map(self.written.__getitem__, ids[np.argsort(place, kind="stable")].tolist()))
        # every part ends where both have a token that ends
        own = steps[closes].searchsorted(np.cumsum([len(p.encode()) for p in parts]))
        at = closes[own]
        out, t, k = [], 0, 0
        for n_a, n_b, n_groups, n_links in zip(*[np.diff(x, prepend=-1).tolist() for x in (i[at], j[at], own, at)]):
            groups = "".join(written[t : t + n_a + n_b])[:-1]
            out.append((n_a, n_b, n_groups, n_links, groups, packed[8 * k : 8 * (k + n_links)]))
            t, k = t + n_a + n_b, k + n_links
        return out


def _piece_bytes(piece: str) -> bytes:
    own = _BYTE.match(piece)
    return bytes([int(own[1], 16)]) if own else piece.replace(BLANK, " ").encode()


def _protos(model, texts: list[str]) -> list:
    """Pieces with spans in bytes. (``immutable_proto``, by its older name, is no longer there.)"""
    return model.encode(texts, return_type="proto", num_threads=1)


def _refine(cuts: np.ndarray, clean: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens: the coarse cut, or where there is none the last one and the bytes decoded since."""
    so_far = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(cuts)), -1))
    since = np.where(last >= 0, cuts[last] - so_far[last], 0)
    return np.where(clean, cuts, since + so_far)


@lru_cache(maxsize=2)
def aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


NONE: Part = (0, 0, 0, 0, "", b"")


def _of_text(aligned: Aligner, text: str | None, parts: list[Part | None]) -> Part:
    if not text:
        return NONE
    if len(parts) > 1 and None in parts:  # the whole decides, so look at it as a whole
        parts = aligned._align([" " + text])
    if None in parts:
        return NONE
    a, b, groups, links, texts, packed = zip(*parts)
    return sum(a), sum(b), sum(groups), sum(links), ";".join(texts), b"".join(packed)


def align(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_file: str | None = None,
    b_file: str | None = None,
    with_groups: bool = False,
) -> DataFrame:
    """``row, doc, n_a, n_b, n_groups, n_links, groups_sha256, pairs`` of each row, and ``groups``
    on request: its text ``a1,a2|b1;a3|b2,b3``.

    ``pairs`` holds each different pair of linked ids once, with its number of links ``n``; ``row``
    is a number of its own for each row. A text that is null, empty, or not spelled by the tokens
    of both (with a blank before it) has no tokens: zeros, no pairs, and an empty text for the
    groups, not hashed. Rows are independent: repeated rows and null ids pass through. Texts are
    read whole, whatever their length; other columns are not read, whatever their names. No rows
    give no rows. Both files must be readable on every executor.
    """
    a_path = a_file or public_tokenizers.path(A_FILE)
    b_path = b_file or public_tokenizers.path(B_FILE)

    def make():
        aligned = aligner(a_path, b_path)
        base, seen = TaskContext.get().partitionId() << 33, 0

        def each(batch):
            nonlocal seen
            for rows in rows_of(batch, 512):
                texts = rows["text"].to_pylist()
                found = [_of_text(aligned, t, p) for t, p in zip(texts, aligned.known([t or "" for t in texts]))]
                counted = [np.unique(np.frombuffer(f[5], np.int64), return_counts=True) for f in found]
                offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in counted])])
                ids = np.concatenate([ids for ids, _ in counted])
                n = np.concatenate([n for _, n in counted])
                fields = [ids >> 32, ids & 0xFFFFFFFF, n]
                pair = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in fields], ["a", "b", "n"])
                out = {
                    "row": np.arange(base + seen, base + seen + len(found)),
                    "doc": rows["doc"],
                    **{c: [f[k] for f in found] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                    "groups_sha256": [hashlib.sha256(f[4].encode()).hexdigest() if f[0] else "" for f in found],
                    "pairs": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pair),
                }
                yield out | ({"groups": [f[4] for f in found]} if with_groups else {})
                seen += len(found)

        return each

    source = id_and_text(df, id_col, text_col)
    schema = (
        f"row bigint, doc {source.schema['doc'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, "
        "n_links bigint, groups_sha256 string, pairs array<struct<a:int,b:int,n:int>>"
    )
    return batched(source, schema + (", groups string" if with_groups else ""), make)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each id pair in all rows, and whether no other id of A has
    more with that id of B."""
    counts = aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts, _ = materialize(counts, "pairs")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def agreement(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The rows of ``aligned`` without pairs, with ``n_best`` and ``count_sum``: how many of their
    links are their B id's most frequent, ties included, and the sum of their counts.

    ``counts`` is broadcast if it has ``broadcast_pairs`` rows at most; beyond that Spark joins by
    shuffle, and AQE cuts frequent pairs.
    """
    counts, told = materialize(counts, "rated", F.count(F.lit(1)).alias("pairs"))
    kept = [c for c in aligned.columns if c != "pairs"]
    links = aligned.select(*kept, F.inline_outer("pairs"))
    rated = links.join(F.broadcast(counts) if told["pairs"] <= broadcast_pairs else counts, ["a", "b"], "left")
    none = F.lit(0).cast("bigint")
    return rated.groupBy(*kept).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(none)).alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("count")), none).alias("count_sum"),
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned, _ = materialize(align(table(spark, sf_dir, "documents")), "aligned")
    found = agreement(aligned, pair_counts(aligned))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return found.select(F.col("doc").alias("doc_id"), *names, "groups_sha256")

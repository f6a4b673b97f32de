"""Operator 6: documents cut and packed into sequences of even cost."""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.bpe import encode_text
from logmill.llm.common import batched, id_and_text, rows_of, table

TOKENIZER = "byte_bpe_50k.json"

def _byte_of_char() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 for
    itself, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Tokens:
    """Ids of texts as the ``tokenizers`` library gives them for a tokenizer file, called with
    ``add_special_tokens=False``: none is added, but an added token's string in a text is its id.

    For a plain byte-level BPE, whose merges are in order of the ids that they make, these are
    the ids of ``tiktoken`` with the file's own vocabulary as ranks, found in a fifth of the
    time, of the texts between added tokens; other files are left to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf8") as file:
            spec = json.load(file)
        self.codec = self.tokenizer = None
        if _plain_bytes(spec):
            char = _byte_of_char()
            self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec.get("added_tokens") or ()}
            # of those that start at one place, the longest counts
            longest = sorted(map(re.escape, self.added), key=len, reverse=True)
            self.between = re.compile(f"({'|'.join(longest)})") if longest else None
            ranks = {bytes(map(char.__getitem__, t)): n for t, n in spec["model"]["vocab"].items() if t not in self.added}
            self.codec = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.codec:
            return [np.frombuffer(self._ids(t), "<u4") for t in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4") for x in found]

    def _ids(self, text: str) -> bytes:
        if self.between is None or not self.between.search(text):
            return encode_text(text, self.codec)
        return b"".join(self.added.get(p) or encode_text(p, self.codec) for p in self.between.split(text) if p)


def _plain_bytes(spec: dict) -> bool:
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or model.get("type") != "BPE" or split.get("type") != "ByteLevel":
        return False
    if split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("dropout") or model.get("byte_fallback"):
        return False
    if any(t.get(flag) for t in spec.get("added_tokens") or () for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        return False
    if model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return False
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    return None not in made and made == sorted(made)


def assign(
    lengths: list[int], capacity: int, linear: float, quadratic: float
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of documents, and the number of sequences.

    Whole capacities of long documents fill a sequence each. What is left is assigned in
    descending order to the sequence of lowest cost with room for it; where none has room, the
    piece is cut to fill the one with the most room, and its rest queues again. The sequences'
    room equals the tokens: the last, incomplete one is split into powers of two, which need
    no padding.
    """
    pieces, n, queue = [], 0, []
    for d, length in enumerate(lengths):
        whole = length // capacity
        for k in range(whole):
            pieces.append((d, k * capacity, capacity, n, 0))
            n += 1
        if rest := length - whole * capacity:
            queue.append((-rest, d, whole * capacity))
    total = -sum(q[0] for q in queue)
    rooms = [capacity] * (total // capacity)
    rooms += [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if (total % capacity) >> b & 1]
    room, cost, first = np.array(rooms, np.int64), np.zeros(len(rooms)), np.array(rooms, np.int64)
    heapq.heapify(queue)
    while queue:
        size, d, start = heapq.heappop(queue)
        size = -size
        s = int(np.argmin(np.where(room >= size, cost, np.inf)))
        if room[s] < size:
            s = int(np.argmax(room))
            heapq.heappush(queue, (int(room[s]) - size, d, start + int(room[s])))
            size = int(room[s])
        pieces.append((d, start, size, n + s, int(first[s] - room[s])))
        room[s] -= size
        cost[s] += linear * size + quadratic * size * size
    return pieces, n + len(rooms)


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    tokenizer_file: str | None = None,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 4096,
    group_tokens: int = 1 << 20,
) -> DataFrame:
    """Pieces of all documents: ``doc, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers. Each task packs its rows in groups of
    about ``group_tokens`` tokens, in the order read, so no row is shuffled and a lost task
    gives the same sequences again; ``sequence_id`` has the task's number above 2^40 and counts
    within it. The cost of a piece is ``linear * n + quadratic * n * n``.

    A null or empty text is ``end_id`` alone. Rows with equal or null ids are documents of
    their own. A text longer than a group is a group by itself. No rows give no sequences.
    """
    path = tokenizer_file or public_tokenizers.path(TOKENIZER)

    def make():
        tokens, base, used = Tokens(path), TaskContext.get().partitionId() << 40, 0

        def flush(docs, ids):
            nonlocal used
            pieces, n = assign([len(i) for i in ids], capacity, linear, quadratic)
            out = {
                "doc": [docs[d] for d, *_ in pieces],
                "start": [p[1] for p in pieces],
                "length": [p[2] for p in pieces],
                "ids": [ids[d][start : start + size].tobytes() for d, start, size, *_ in pieces],
                "doc_tokens": [len(ids[d]) for d, *_ in pieces],
                "sequence_id": [base + used + p[3] for p in pieces],
                "offset": [p[4] for p in pieces],
            }
            used += n
            return out

        end = np.array([end_id], "<u4")
        docs, held, size = [], [], 0

        def each(batch):
            nonlocal docs, held, size
            if batch is None:
                if docs:
                    yield flush(docs, held)
                return
            for rows in rows_of(batch, 128):
                ids = [np.append(i, end) for i in tokens.encode([t or "" for t in rows["text"].to_pylist()])]
                for doc, own in zip(rows["doc"].to_pylist(), ids):
                    docs.append(doc)
                    held.append(own)
                    size += len(own)
                    if size >= group_tokens:
                        yield flush(docs, held)
                        docs, held, size = [], [], 0

        return each

    source = id_and_text(df, id_col, text_col)
    schema = (
        f"doc {source.schema['doc'].dataType.simpleString()}, start bigint, length bigint, ids binary, "
        "doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return batched(source, schema, make, ends=True)


def op6_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("doc").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )

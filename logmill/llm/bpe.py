"""Operator 8: byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import batched, id_and_text, rows_of, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Texts above so many characters are encoded in parts.
PART = 1 << 16
#: A blank between two characters that are no white space. Every alternative of the
#: pattern that takes the blank starts with it, so no match reaches across its left edge.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name="ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, cut only where no match can be cut."""
    start = 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, codec: tiktoken.Encoding, size: int = PART) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    if len(text) <= size:
        return np.asarray(codec.encode_ordinary(text), "<u4").tobytes()
    return b"".join(np.asarray(codec.encode_ordinary(p), "<u4").tobytes() for p in parts(text, size))


def encode(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``doc`` and ``ids`` (binary: little-endian unsigned 32-bit) of each row.

    ``rank_file`` must be readable on every executor. A null or empty text has no ids.
    Rows are independent: repeated rows and null ids pass through. Other columns are not
    read, whatever their names. A very long text is encoded in parts; a run without a
    safe boundary stays one part.
    """
    path = rank_file or public_tokenizers.path(RANKS)

    def make():
        codec = encoding(path, pattern)

        def each(batch):
            for rows in rows_of(batch):
                texts = rows["text"].to_pylist()
                yield {"doc": rows["doc"], "ids": [encode_text(t or "", codec) for t in texts]}

        return each

    source = id_and_text(df, id_col, text_col)
    return batched(source, f"doc {source.schema['doc'].dataType.simpleString()}, ids binary", make)


def decode(
    df: DataFrame,
    id_col: str = "doc",
    ids_col: str = "ids",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``doc``, ``ids`` and ``decoded``: the raw bytes of the ids, which need not be whole characters.

    Null ids decode to nothing. An id that the rank file lacks is an error (``KeyError``).
    """
    path = rank_file or public_tokenizers.path(RANKS)

    def make():
        codec = encoding(path, pattern)

        def each(batch):
            for rows in rows_of(batch):
                ids = [i or b"" for i in rows["ids"].to_pylist()]
                yield {
                    "doc": rows["doc"],
                    "ids": ids,
                    "decoded": [codec.decode_bytes(np.frombuffer(i, "<u4").tolist()) for i in ids],
                }

        return each

    source = df.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{ids_col}`").alias("ids"))
    kind = source.schema["doc"].dataType.simpleString()
    return batched(source, f"doc {kind}, ids binary, decoded binary", make)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        F.col("doc").alias("doc_id"),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Operator 4: language ID by prediction by partial matching.

Each language has a tree of byte contexts up to a fixed order, counted once on a bounded
sample of labelled rows and then frozen. A byte costs -log2 of its share in the longest
context of the tree that precedes it; a byte not seen there pays the context's escape
probability (method C: symbols seen / (symbols seen + occurrences)) and is looked for one
byte shorter, down to equal shares of all symbols. The language with the shortest code for
the whole text wins.

Bytes are folded to symbols first: ASCII capitals to small letters, digits, white space and
ASCII punctuation to one symbol each, bytes that the sample lacks to one more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logmill.llm.common import batched, id_and_text, rows_of, table, utf8

ORDER = 3
UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")
_PIECE = 1 << 20


@dataclass
class Model:
    """Frozen code lengths. ``row`` maps three symbols of context to a row of ``cost``,
    the row's symbols follow each other, and each has a code length per language."""

    languages: list[str]
    symbol: np.ndarray
    size: int
    row: np.ndarray
    cost: np.ndarray

    @property
    def start(self) -> int:
        return int(self.symbol[32])


def _fold() -> np.ndarray:
    to = np.arange(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        to[b] = ord(c.lower()) if c.isalpha() else 48 if c.isdigit() else 32 if c.isspace() or b < 32 else 46
    return to


def fit(texts: dict[str, list[bytes]], most_contexts: int = 40_000) -> Model:
    """Count the trees of all languages and work out every code length.

    Of the contexts of full order, the ``most_contexts`` most frequent over all languages
    are kept, which bounds the model.
    """
    fold, languages = _fold(), sorted(texts)
    seen = np.zeros(256, bool)
    for own in texts.values():
        for t in own:
            seen[fold[np.frombuffer(t, np.uint8)]] = True
    seen[32] = True
    known = np.flatnonzero(seen)
    size = len(known) + 1
    symbol = np.full(256, size - 1, np.int64)
    symbol[known] = np.arange(len(known))
    symbol = symbol[fold]
    start = int(symbol[32])
    grams = {}
    for lang in languages:
        streams = [np.full(ORDER, start)]
        for t in texts[lang]:
            streams += [symbol[np.frombuffer(t, np.uint8)], np.full(ORDER, start)]
        x = np.concatenate(streams)
        grams[lang] = np.unique(((x[:-3] * size + x[1:-2]) * size + x[2:-1]) * size + x[3:], return_counts=True)
    context = np.concatenate([g // size for g, _ in grams.values()] or [np.zeros(0, np.int64)])
    times = np.concatenate([n for _, n in grams.values()] or [np.zeros(0, np.int64)])
    kept, where = np.unique(context, return_inverse=True)
    often = np.bincount(where, times, len(kept))
    kept = np.sort(kept[np.lexsort((kept, -often))[:most_contexts]])
    cost = np.zeros((len(kept) + size * size, size, len(languages)), np.float32)
    for k, lang in enumerate(languages):
        gram, n = grams[lang]
        p = np.full(size, 1.0 / size)
        p = _level(np.bincount(gram % size, n, size)[None, :], p[None, :])[0]
        p = _level(np.bincount(gram % size**2, n, size**2).reshape(size, size), np.broadcast_to(p, (size, size)))
        two = _level(
            np.bincount(gram % size**3, n, size**3).reshape(-1, size), np.tile(p, (size, 1)).reshape(size * size, size)
        )
        at = np.searchsorted(kept, gram // size)
        hit = (at < len(kept)) & (kept[np.minimum(at, max(len(kept) - 1, 0))] == gram // size) if len(kept) else at < 0
        counts = np.zeros((len(kept), size))
        counts[at[hit], gram[hit] % size] = n[hit]
        three = _level(counts, two[kept % size**2])
        cost[: len(kept), :, k] = -np.log2(three)
        cost[len(kept) :, :, k] = -np.log2(two)
    row = np.tile(np.arange(size * size, dtype=np.int32) + len(kept), size)
    row[kept] = np.arange(len(kept))
    return Model(languages, symbol, size, row, cost.reshape(len(cost) * size, len(languages)))


def _level(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities in each context from its counts and those of the context one byte shorter."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    whole = np.maximum(total + kinds, 1)
    escape = np.where(total > 0, kinds / whole, 1.0)
    return np.where(counts > 0, counts / whole, escape * shorter)


def code_lengths(texts: list[bytes], model: Model) -> np.ndarray:
    """Bits for each text and language, with the blanks that follow it and reset the context."""
    gap = b" " * ORDER
    ends = ORDER + np.cumsum([len(t) + ORDER for t in texts])
    x = np.frombuffer(gap.join([b"", *texts, b""]), np.uint8)
    bits = np.zeros((len(texts), len(model.languages)))
    size = model.size
    for at in range(ORDER, len(x), _PIECE):
        s = model.symbol[x[at - ORDER : at + _PIECE]]
        context = (s[:-3] * size + s[1:-2]) * size + s[2:-1]
        cost = model.cost[model.row[context].astype(np.int64) * size + s[3:]]
        first = np.searchsorted(ends, at, "right")
        last = np.searchsorted(ends, at + len(cost) - 1, "right")
        cuts = np.concatenate([[0], ends[first:last] - at])
        bits[first : last + 1] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)
    return bits


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode("utf8", "replace"))


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 600,
    longest: int = 1 << 16,
    most_contexts: int = 40_000,
) -> Model:
    """Fit on at most ``docs_per_language`` whole labelled texts of up to ``longest`` bytes of
    each language, those of least id hash among the rows that aren't held out.

    Rows without id, text or label are not learned from. The driver gets no more than that
    sample, whatever the input.
    """
    source = id_and_text(df, id_col, text_col, F.col(f"`{lang_col}`").alias("lang"))
    source = source.filter(
        F.col("doc").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc"))
    ).filter(F.octet_length("text").between(1, longest))
    place = F.pmod(F.xxhash64(F.col("doc").cast("string")), F.lit(1 << 20))
    counts = source.groupBy("lang").count()
    share = counts.select("lang", (F.lit(1.5 * docs_per_language * (1 << 20)) / F.col("count")).alias("share"))
    few = source.select("lang", "text", "doc", place.alias("place")).join(F.broadcast(share), "lang")
    order = Window.partitionBy("lang").orderBy("place", "doc", "text")
    few = few.filter("place < share").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs_per_language)
    texts: dict[str, list[bytes]] = {}
    for row in few.select("lang", F.col("text").cast("binary").alias("text")).toLocalIterator():
        texts.setdefault(row["lang"], []).append(bytes(row["text"]))
    return fit(texts, most_contexts)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, lang_pred, score``: the language of the whole text and its share of the
    probability over all languages.

    A null text, one without a letter, and any text when nothing was learned give ``und``
    with score 0. Ties go to the language first in order of name. Rows are independent:
    repeated rows and null ids pass through; other columns are not read.
    """
    source = id_and_text(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def each(batch):
            for rows in rows_of(batch, 128):
                texts = utf8(rows["text"])
                right = [bool(own.languages) and has_letter(t) for t in texts]
                scored = iter(_best(code_lengths([t for t, r in zip(texts, right) if r], own)) if any(right) else ())
                found = [next(scored) if r else (None, 0.0) for r in right]
                yield {
                    "doc": rows["doc"],
                    "lang_pred": [UNKNOWN if k is None else own.languages[k] for k, _ in found],
                    "score": [s for _, s in found],
                }

        return each

    kind = source.schema["doc"].dataType.simpleString()
    return batched(source, f"doc {kind}, lang_pred string, score double", make)


def _best(bits: np.ndarray) -> list[tuple[int, float]]:
    best = bits.argmin(1)
    shares = np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000)).sum(1)
    return list(zip(best.tolist(), (1 / shares).tolist()))


def op4_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = predict(documents, train(documents))
    return found.select(F.col("doc").alias("doc_id"), held_out(F.col("doc")).alias("held_out"), "lang_pred", "score")

"""Operator 9: removal of byte strings that occur again, by sorted suffix tuples.

A full suffix array of the input is not built: its tuples alone are several times the text,
more than the disk that the job may use (see README). Only suffixes at content-defined
places are sorted, and what the others share is induced from them:

1. *Anchors.* Every byte string of ``length`` bytes has, among the starts of its ``gram``-byte
   strings, those of least hash. Equal strings have them at equal places, so a place that is
   least in some such string is an anchor, and every string reaches over an anchor of its own.
2. *Tuples.* An anchor's tuple is the hash of its gram and that of its context: the bytes that
   strings over it can cover. An external sort (Spark's, on disk where memory ends) brings
   equal grams together. A gram found once induces nothing. A context found twice means that
   all strings over it occur again.
3. *Induction.* Where grams are equal and contexts differ, the contexts themselves are fetched
   and every string over the anchor is compared by its hash: the common left and right parts
   of two contexts decide which strings both have.

Strings are judged on the input. Hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import any_without_id, batched, id_and_text, key_of, materialize, mix, rows_of, table, utf8
from logmill.llm.shingles import _BASE, _powers

LENGTH = 400
GRAM = 256
#: Bytes of a text worked on at once; parts overlap, so that no string is missed.
PART = 1 << 18
#: Contexts of one gram compared in one task; more are compared by a shuffle of their strings.
MANY = 1 << 13


def _slide(a: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values, from those of blocks' heads and tails."""
    f, fill = (np.minimum, 2**64 - 1) if least else (np.maximum, 0)
    b = np.full(-(-len(a) // width) * width, fill, np.uint64)
    b[: len(a)] = a
    b = b.reshape(-1, width)
    heads = f.accumulate(b, axis=1).ravel()
    tails = f.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(tails[: len(a) - width + 1], heads[width - 1 : len(a)])


class Anchors:
    """Anchors of byte strings: place, gram hash, context hash, bytes of context before and after."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.reach = length, gram, length - gram
        n = PART + 3 * length
        self.up, self.down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)

    def of(self, text: bytes) -> tuple[np.ndarray, ...]:
        found = []
        for at in range(0, max(len(text) - self.length + 1, 0), PART):
            # strings that start in this part, and room for the contexts of their anchors
            low = max(at - self.reach, 0)
            part = text[low : at + PART + self.length - 1 + self.reach]
            first, last = at - low, min(at - low + PART + self.length - 1, len(part))
            place, gram, context, left, right = self._part(part, first, last)
            found.append((place + low, gram, context, left, right))
        if not found:
            return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
        if len(found) == 1:
            return found[0]
        place, *rest = (np.concatenate(x) for x in zip(*found))
        _, once = np.unique(place, return_index=True)
        return (place[once], *(x[once] for x in rest))

    def _part(self, part: bytes, first: int, last: int) -> tuple[np.ndarray, ...]:
        sums = np.zeros(len(part) + 1, np.uint64)
        x = np.frombuffer(part, np.uint8).astype(np.uint64) + np.uint64(1)
        np.cumsum(x * self.up[: len(x)], out=sums[1:])
        ends = last - self.gram + 1
        h = mix((sums[first + self.gram : last + 1] - sums[first:ends]) * self.down[first:ends])
        width = self.reach + 1
        least = np.zeros(len(h) + width - 1, np.uint64)
        least[width - 1 : len(h)] = _slide(h, width, True)
        place = np.flatnonzero(h == _slide(least, width, False))
        gram, place = h[place], place + first
        low, high = np.maximum(place - self.reach, 0), np.minimum(place + self.length, len(part))
        left, right = place - low, high - place
        context = mix((sums[high] - sums[low]) * self.down[low])
        context = mix(context ^ (left * 1_000_003 + right).astype(np.uint64))
        return place, gram, context, left, right


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that spans cover together; spans that touch are one run."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


def string_hashes(contexts: list[bytes], left: np.ndarray, right: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each string over each anchor (column: its bytes before the anchor), and whether there is one."""
    reach = length - gram
    width = length + reach
    up, down = _powers(_BASE, width + 1), _powers(pow(_BASE, -1, 2**64), width + 1)
    before = np.arange(reach + 1)
    first = reach - before
    value = np.zeros((len(contexts), reach + 1), np.uint64)
    for at in range(0, len(contexts), 1024):
        part = contexts[at : at + 1024]
        rows = np.zeros((len(part), width), np.uint64)
        for k, (c, n) in enumerate(zip(part, left[at : at + 1024].tolist())):
            rows[k, reach - n : reach - n + len(c)] = np.frombuffer(c, np.uint8)
        rows += np.uint64(1)
        rows *= up[:width]
        sums = np.zeros((len(part), width + 1), np.uint64)
        np.cumsum(rows, axis=1, out=sums[:, 1:])
        value[at : at + 1024] = mix((sums[:, first + length] - sums[:, first]) * down[first])
    return value, (before <= left[:, None]) & (length - before <= right[:, None])


# -- Spark steps -----------------------------------------------------------------------------

_ROW = "key bigint, context bigint, doc {kind}, t bigint, place bigint, before bigint, after bigint"


def _tuples(source: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    """Suffix tuples of all anchors. From the third time that a task meets a context it is
    known to occur again: its span is given at once, with a null context."""

    def make():
        anchors = Anchors(length, gram)
        once: set[int] = set()
        twice: set[int] = set()

        def fresh(both: np.ndarray) -> np.ndarray:
            keep = np.ones(len(both), bool)
            for k, x in enumerate(both.tolist()):
                if x in twice:
                    keep[k] = False
                elif x in once:
                    twice.add(x)
                else:
                    once.add(x)
            return keep

        def each(batch):
            for rows in rows_of(batch, 64):
                if len(once) > 1 << 20:
                    once.clear()
                    twice.clear()
                out = {c: [] for c in ("key", "context", "place", "before", "after", "at", "known")}
                for n, text in enumerate(utf8(rows["text"])):
                    place, key, context, left, right = anchors.of(text)
                    if not len(place):
                        continue
                    keep = fresh(mix(key) ^ context)
                    a, b = merged((place - left)[~keep], (place + right)[~keep])
                    out["key"] += [key[keep].view(np.int64), mix(a.astype(np.uint64) + key[0]).view(np.int64)]
                    out["context"] += [context[keep].view(np.int64), np.zeros(len(a), np.int64)]
                    out["place"] += [place[keep], a]
                    out["before"] += [left[keep], np.zeros(len(a), np.int64)]
                    out["after"] += [right[keep], b - a]
                    out["at"].append(np.full(keep.sum() + len(a), n))
                    out["known"] += [np.zeros(keep.sum(), bool), np.ones(len(a), bool)]
                if not out["at"]:
                    continue
                col = {c: np.concatenate(v) for c, v in out.items()}
                yield {
                    "key": col["key"],
                    "context": pa.array(col["context"], mask=col["known"]),
                    "doc": rows["doc"].take(pa.array(col["at"])),
                    "t": rows["t"].take(pa.array(col["at"])),
                    "place": col["place"],
                    "before": col["before"],
                    "after": col["after"],
                }

        return each

    return batched(source, _ROW.format(kind=kind), make)


def _groups(tuples: DataFrame, kind: str, many: int) -> DataFrame:
    """The sorted tuples, as spans (``open`` null) and as anchors still to be compared
    (``open`` false, or true for grams of more than ``many`` contexts).

    A task reads its sorted rows once and holds one gram's rows, at most ``many`` of them."""

    def make():
        held: pa.Table | None = None
        hot: int | None = None  # a gram that is being read in parts

        def done(t: pa.Table, forced: bool):
            """Rows of whole grams (or, if forced, of a part of one)."""
            key, context = t["key"].to_numpy(), t["context"].fill_null(0).to_numpy()
            span = t["context"].is_null().to_numpy()
            same = np.concatenate([[False], (key[1:] == key[:-1]) & (context[1:] == context[:-1]) & ~span[1:] & ~span[:-1]])
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.flatnonzero(~same)
            copies = np.diff(np.append(first, len(key)))
            again = np.repeat(copies > 1, copies)
            group = np.cumsum(new_key) - 1
            contexts = np.bincount(group[~same & ~span], minlength=group[-1] + 1)[group]
            known = span | again
            opened = ~span & ~same & ((contexts > 1) | forced)
            place, before, after = (t[c].to_numpy() for c in ("place", "before", "after"))
            rows = np.concatenate([np.flatnonzero(known), np.flatnonzero(opened)])
            mark = np.zeros(len(rows), bool)
            mark[: known.sum()] = True
            busy = (contexts > many) | forced
            return {
                "key": pa.array(key[rows]),
                "doc": t["doc"].take(pa.array(rows)).combine_chunks(),
                "t": t["t"].take(pa.array(rows)).combine_chunks(),
                "place": place[rows],
                "before": before[rows],
                "after": after[rows],
                "open": pa.array(busy[rows], mask=mark),
            }

        def each(batch):
            nonlocal held, hot
            t = pa.Table.from_batches([batch]) if batch is not None else held
            if batch is not None and held is not None:
                t = pa.concat_tables([held, t])
            if t is None or not t.num_rows:
                return
            key, n, start = t["key"].to_numpy(), t.num_rows, 0
            whole = n if batch is None else int(np.searchsorted(key, key[-1], "left"))
            if hot is not None:
                end = int(np.searchsorted(key, hot, "right"))
                if end < n or batch is None:
                    yield done(t.slice(0, end), True)
                    start, hot = end, None
            if whole > start:
                yield done(t.slice(start, whole - start), False)
            held = t.slice(max(whole, start))
            if held.num_rows > 4 * many:
                # all of one gram; its last context stays behind, so that copies meet
                context = held["context"].fill_null(0).to_numpy()
                others = np.flatnonzero(context != context[-1])
                if len(others):
                    yield done(held.slice(0, others[-1] + 1), True)
                    held, hot = held.slice(others[-1] + 1), int(key[-1])
            held = held.combine_chunks()

        return each

    schema = f"key bigint, doc {kind}, t bigint, place bigint, before bigint, after bigint, open boolean"
    ordered = tuples.repartition("key").sortWithinPartitions("key", "context")
    return batched(ordered, schema, make, ends=True)


def _contexts(source: DataFrame, opened: DataFrame) -> DataFrame:
    """``key, doc, t, place, before, after, open, bytes``: the contexts of anchors, out of their texts."""
    wanted = opened.groupBy("doc", "t").agg(F.collect_list(F.struct("key", "place", "before", "after", "open")).alias("want"))
    both = _packed(source).join(wanted, ["doc", "t"])
    kind = source.schema["doc"].dataType.simpleString()

    def make():
        unpack = zstandard.ZstdDecompressor()

        def each(batch):
            for rows in rows_of(batch, 64):
                out = {c: [] for c in ("key", "place", "before", "after", "open", "bytes", "at")}
                for n, (packed, want) in enumerate(zip(rows["packed"], rows["want"].to_pylist())):
                    text = unpack.decompress(packed.as_py())
                    for w in want:
                        for c in ("key", "place", "before", "after", "open"):
                            out[c].append(w[c])
                        out["bytes"].append(text[w["place"] - w["before"] : w["place"] + w["after"]])
                        out["at"].append(n)
                at = pa.array(out.pop("at"), pa.int64())
                yield out | {"doc": rows["doc"].take(at), "t": rows["t"].take(at)}

        return each

    return batched(
        both, f"key bigint, doc {kind}, t bigint, place bigint, before bigint, after bigint, open boolean, bytes binary", make
    )


def _packed(source: DataFrame, carry: bool = False) -> DataFrame:
    """Texts compressed, as they are moved to what belongs to them."""
    kinds = {f: source.schema[f].dataType.simpleString() for f in source.columns}

    def make():
        pack = zstandard.ZstdCompressor(level=3)

        def each(batch):
            for rows in rows_of(batch, 64):
                more = {"carry": rows["carry"]} if carry else {}
                yield {"doc": rows["doc"], "t": rows["t"], "packed": [pack.compress(t) for t in utf8(rows["text"])]} | more

        return each

    return batched(
        source, f"doc {kinds['doc']}, t bigint, packed binary" + (f", carry {kinds['carry']}" if carry else ""), make
    )


def _induced(contexts: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    """Spans ``doc, t, start, stop`` of strings over anchors that other contexts of the gram have, too."""

    def compare(t: pa.Table):
        key, place, left, right = (t[c].to_numpy() for c in ("key", "place", "before", "after"))
        value, real = string_hashes(t["bytes"].to_pylist(), left, right, length, gram)
        value = mix(value ^ mix(key.view(np.uint64))[:, None])
        order = np.argsort(value, axis=0)
        ordered, ok = np.take_along_axis(value, order, 0), np.take_along_axis(real, order, 0)
        # strings that don't exist sort among the others by chance only; they never count
        equal = (ordered[1:] == ordered[:-1]) & ok[1:] & ok[:-1]
        found = np.zeros(real.shape, bool)
        twice = np.zeros(real.shape, bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        np.put_along_axis(found, order, twice, 0)
        rows = np.flatnonzero(found.any(1))
        most = length - gram - found[rows, ::-1].argmax(1)
        least = found[rows].argmax(1)
        at = pa.array(rows)
        return {
            "doc": t["doc"].take(at).combine_chunks(),
            "t": t["t"].take(at).combine_chunks(),
            "start": place[rows] - most,
            "stop": place[rows] + length - least,
        }

    def make():
        held: pa.Table | None = None

        def each(batch):
            nonlocal held
            for part in rows_of(batch, 4096) if batch is not None else [None]:
                t = pa.Table.from_batches([part]) if part is not None else None
                if t is not None and held is not None:
                    t = pa.concat_tables([held, t])
                elif t is None:
                    t = held
                if t is None or not t.num_rows:
                    continue
                key = t["key"].to_numpy()
                cut = t.num_rows if part is None else int(np.searchsorted(key, key[-1], "left"))
                if cut:
                    yield compare(t.slice(0, cut))
                held = t.slice(cut) if cut < t.num_rows else None

        return each

    ordered = contexts.drop("open").repartition("key").sortWithinPartitions("key")
    return batched(ordered, f"doc {kind}, t bigint, start bigint, stop bigint", make, ends=True)


def _induced_by_shuffle(contexts: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    """The same for grams of very many contexts: strings are counted by a partial and a final
    aggregate, and those found again go back to their anchors."""

    def make():
        def each(batch):
            for rows in rows_of(batch, 256):
                key, place, left, right = (rows[c].to_numpy() for c in ("key", "place", "before", "after"))
                value, real = string_hashes(rows["bytes"].to_pylist(), left, right, length, gram)
                value = mix(value ^ mix(key.view(np.uint64))[:, None])
                at, before = np.nonzero(real)
                yield {
                    "string": mix(value[at, before] + before.astype(np.uint64)).view(np.int64),
                    "doc": rows["doc"].take(pa.array(at)),
                    "t": rows["t"].take(pa.array(at)),
                    "start": place[at] - before,
                }

        return each

    strings = batched(contexts, f"string bigint, doc {kind}, t bigint, start bigint", make)
    again = strings.groupBy("string").count().filter("count > 1").select("string")
    return strings.join(again, "string").select("doc", "t", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(source: DataFrame, length: int, gram: int, many: int) -> DataFrame:
    """``doc, t, start, stop``: spans whose every byte lies in a string that occurs again."""
    kind = source.schema["doc"].dataType.simpleString()
    seen, told = materialize(
        _groups(_tuples(source, kind, length, gram), kind, many), "anchors", F.count_if("open").alias("busy")
    )
    spans = seen.filter("open is null").select(
        "doc", "t", (F.col("place") - F.col("before")).alias("start"), (F.col("place") + F.col("after")).alias("stop")
    )
    spans = spans.union(_induced(_contexts(source, seen.filter("not open")), kind, length, gram))
    if told["busy"]:
        spans = spans.union(_induced_by_shuffle(_contexts(source, seen.filter("open")), kind, length, gram))
    return spans


def without_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    many: int = MANY,
    carry: Column | None = None,
    as_text: bool = False,
) -> DataFrame:
    """``doc, kept, n_bytes, n_removed, n_spans`` and ``carry`` of every row with an id.

    ``kept`` has the UTF-8 bytes that no string of ``length`` bytes covers which starts at
    another place, too, of this or another text; it may begin or end within a character. With
    ``as_text`` it is a string, and bytes that are no whole character any more go, too. Null
    and empty texts have no bytes. Rows with equal ids count as texts of their own. Rows with
    a null id are left out: give ``key_of`` as the id where there are some.
    """
    carry = F.lit(None).cast("int") if carry is None else carry
    rows = df.filter(F.col(f"`{id_col}`").isNotNull())
    ids = rows.groupBy(F.col(f"`{id_col}`").alias("doc")).count().filter("count > 1")
    # a text's hash tells rows of one id apart; where ids are distinct it isn't carried along
    t = F.lit(0).cast("bigint") if ids.isEmpty() else F.xxhash64(F.col(f"`{text_col}`"))
    spans = repeated_spans(id_and_text(rows, id_col, text_col, t.alias("t")), length, gram, many)
    spans = spans.groupBy("doc", "t").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    both = _packed(id_and_text(rows, id_col, text_col, t.alias("t"), carry.alias("carry")), True)
    both = both.join(spans, ["doc", "t"], "left")

    def make():
        unpack = zstandard.ZstdDecompressor()

        def each(batch):
            for part in rows_of(batch, 64):
                out = {c: [] for c in ("kept", "n_bytes", "n_removed", "n_spans")}
                for packed, spans in zip(part["packed"].to_pylist(), part["spans"]):
                    text = unpack.decompress(packed)
                    found = spans.values if spans.is_valid else None
                    a, b = (found.field(c).to_numpy() for c in (0, 1)) if found is not None else (np.zeros(0, np.int64),) * 2
                    a, b = merged(a, b)
                    edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(text)]
                    kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    out["kept"].append(kept.decode("utf8", "ignore") if as_text else kept)
                    out["n_bytes"].append(len(text))
                    out["n_removed"].append(int((b - a).sum()))
                    out["n_spans"].append(len(a))
                yield out | {"doc": part["doc"], "carry": part["carry"]}

        return each

    kinds = {f: both.schema[f].dataType.simpleString() for f in ("doc", "carry")}
    return batched(
        both,
        f"doc {kinds['doc']}, carry {kinds['carry']}, kept {'string' if as_text else 'binary'}, n_bytes bigint, n_removed bigint, n_spans bigint",
        make,
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, own = table(spark, sf_dir, "documents"), "doc"
    if any_without_id(docs):
        docs, own = docs.select(key_of().alias("doc_id"), "text"), "doc.id"
    return without_repeats(docs).select(
        F.col(own).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

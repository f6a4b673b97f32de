"""Operator 1: exact Jaccard join of word n-gram sets by universe partition and pigeonhole.

Sets of sizes r and s with Jaccard similarity t or more differ in at most H = (r + s) * (1 - t) /
(1 + t) elements. Sizes fall into bands from one power of two to the next. A band cuts the
universe (the hash space) into segments; a set's part of each segment is a subset.

*Value 1, a segment's subset.* A set emits its H + 1 dearest subsets: those with most
elements first, as a subset's expected number of equals falls with each element, ties by hash.
Empty subsets are never emitted (value 0). Take two sets with at most H differing elements: at
most H subsets differ, and the order depends on the subset alone, so of the subsets that both
share the first one stands among the first H + 1 of either.

*Value 2, a subset and its neighbourhood of one deletion.* In small bands a segment is asked
to match with one difference, and so counts twice: segments are taken in order until their
values reach H + 1. A value of 2 costs a signature for each element and one more; with few
elements that buys whole subsets of the set instead of single elements.

A set looks for partners in its own band, and in the band below if a partner may lie there.
Sets that run out of subsets (hashing put too many elements into few segments) are told by their
band; if there are any, all sets of sizes within reach of these bands also emit single elements
(their H + 1 smallest), which never run out.

Equal sets are one node, whose name is a 64-bit hash. A second hash tells whether different sets
have one name; these get names from both. Signatures are sorted, on disk where memory ends, and
read as a stream. Of one that many sets of a task have, the first few go that way, so that they
meet those of other tasks; that they are many is known, and the others are dealt out evenly.

Sets that share a signature are candidates, and pairs are verified on
whole sets in three steps, each on what the one before has not joined: first each set's pair
with most shared signatures, then the closest pairs in groups of many sets, then all that may
still join different components. In groups of many sets, pairs are held against a bound from
parity bitmaps, block by block, before they become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import any_without_id, batched, by_group, id_and_text, key_of, materialize, mix, rows_of, table, utf8
from logmill.llm.components import components
from logmill.llm.shingles import WORDS, Words, sets_of

#: Sets below this size use values of 2.
SMALL = 16
#: Groups up to this size give all their pairs at once.
FEW = 12
#: Members of one block when a large group is compared.
BLOCK = 2048
#: Large groups that a set names, so that its pairs become rows once.
NAMED = 64
#: Names that different sets share, at most: some hundred at 10^11 sets.
MOST_SHARED = 100_000
#: Rows that a task takes together, of signatures made or read.
ROWS = 1 << 18
_RAN_OUT = np.int64(-1)


class Threshold:
    """Similarity ``num / den`` or more, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def differ(self, both: int) -> int:
        """Most differing elements of two sets with ``both`` elements together."""
        return both * (self.den - self.num) // (self.den + self.num)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def smallest(self, n: int) -> int:
        return -(-n * self.num // self.den)


def _tag(values: np.ndarray, *salt: int) -> np.ndarray:
    seed = np.uint64(0)
    for s in salt:
        seed = mix(np.array([int(seed) ^ (s + 0x5851F42D4C957F2D)], np.uint64))[0]
    return mix(values ^ seed)


def _subsets(u: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment number, hash and size of each non-empty subset of a sorted set."""
    segment = ((u >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    return segment[first].astype(np.int64), np.add.reduceat(mix(u), first), np.diff(np.append(first, len(u)))


def _scheme(u: np.ndarray, band: int, differ: int) -> tuple[np.ndarray, bool]:
    """Signatures of a set in a band's scheme, and whether it ran out of subsets."""
    need = differ + 1
    if 1 << band >= SMALL:
        segments = 1 << band
        number, value, size = _subsets(u, segments)
        order = np.lexsort((value, -size))[:need]
        return _tag(value[order] + _tag(number[order].astype(np.uint64), band), 1, band), len(number) < need
    if need == 1:
        return _tag(np.add.reduce(mix(u), keepdims=True), 2, band), False
    segments = max(1, (1 << band) // 4)
    segment = ((u >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    out = []
    for k in range(min(segments, (need + 1) // 2)):
        own = mix(u[segment == k])
        whole = np.add.reduce(own, keepdims=True)
        near = whole - own if need - 2 * k >= 2 else own[:0]
        out.append(_tag(np.concatenate([whole, near]), 3, band, k))
    return np.concatenate(out), 2 * segments < need


def signatures(u: np.ndarray, t: Threshold) -> tuple[np.ndarray, bool]:
    n = len(u)
    band = n.bit_length() - 1
    found, out = _scheme(u, band, t.differ(n + t.largest(n)))
    if band and t.smallest(n) < 1 << band:
        lower, also = _scheme(u, band - 1, t.differ(n + (1 << band) - 1))
        found, out = np.concatenate([found, lower]), out or also
    return np.unique(found), out


def elements(u: np.ndarray, t: Threshold) -> np.ndarray:
    """Signatures that no set runs out of: its smallest elements."""
    return _tag(u[: t.differ(len(u) + t.largest(len(u))) + 1], 4)


def name_of(u: np.ndarray, salt: int = 0xD1B54A32D192ED03) -> int:
    """A hash of all of a set's elements and their number."""
    total = int(np.add.reduce(mix(u ^ np.uint64(salt)))) + len(u) * 0x9E3779B97F4A7C15
    return int(mix(np.array([total & (2**64 - 1)], np.uint64)).view(np.int64)[0])


class Names:
    """Names of sets: a hash, and for those that different sets are known to share another of two."""

    def __init__(self, shared: frozenset[int] = frozenset()):
        self.shared = shared

    def both(self, u: np.ndarray) -> tuple[int, int]:
        """The name, and the second hash."""
        name, check = name_of(u), name_of(u, 0xA0761D6478BD642F)
        if name in self.shared:
            name = int(mix(mix(np.array([check], np.int64).view(np.uint64)) + np.uint64(name & (2**64 - 1))).view(np.int64)[0])
        return name, check

    def of(self, u: np.ndarray) -> int:
        name = name_of(u)
        return self.both(u)[0] if name in self.shared else name


def bitmap(u: np.ndarray) -> bytes:
    """Parities of the elements over a power of two of places, at least eight times as many as elements (2^13 at most)."""
    bits = 1 << min(max(8, (8 * len(u) - 1).bit_length()), 13)
    odd = np.bincount((mix(u) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _fold(own: bytes, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(own, np.uint64).reshape(-1, words), axis=0)


# -- Spark steps -----------------------------------------------------------------------------


def sets(df: DataFrame, id_col: str, text_col: str, width: int, names: Names) -> DataFrame:
    """``doc, n, name, check`` of each row; name and check are null for an empty set."""
    source = id_and_text(df, id_col, text_col)

    def make():
        words = Words()

        def each(batch):
            for rows in rows_of(batch):
                own = sets_of(utf8(rows["text"]), words, width)
                name, check = zip(*[names.both(u) if len(u) else (None, None) for u in own]) if own else ((), ())
                yield {"doc": rows["doc"], "n": [len(u) for u in own], "name": name, "check": check}

        return each

    return batched(source, f"doc {source.schema['doc'].dataType.simpleString()}, n bigint, name bigint, check bigint", make)


def named_sets(df: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, Names]:
    """``doc, n, name`` of each row, stored, and the names with which different sets differ.

    Of N sets, N^2 / 2^65 pairs share a first hash by chance; those are looked for, and few.
    """
    names = Names()
    while True:
        docs, _ = materialize(sets(df, id_col, text_col, width, names), "set-names")
        told = docs.filter("name IS NOT NULL").groupBy("name").agg(F.min("check").alias("a"), F.max("check").alias("b"))
        shared = frozenset(r["name"] for r in told.filter("a <> b").select("name").limit(MOST_SHARED + 1).collect())
        if not shared:
            return docs.drop("check"), names
        if len(shared) > MOST_SHARED or shared <= names.shared:
            raise RuntimeError("too many different sets share a name")
        names = Names(names.shared | shared)


def _emit(df: DataFrame, text_col: str, width: int, t: Threshold, names: Names, bands: list[int] | None = None) -> DataFrame:
    """``sig, name, rep`` of every set, once per task; with ``bands``, single elements of sets within
    reach of these bands of sizes. A band in which a set ran out has the signature -1.

    ``rep`` is null, except for a set that shares the signature with many others at hand: it is
    the first of these.
    """
    source = df.select(F.col(f"`{text_col}`").alias("text"))

    def make():
        words, seen, lost, held, count = Words(), set(), set(), [], 0

        def of(u):
            if bands is None:
                found, out = signatures(u, t)
                return found.view(np.int64), out
            near = any(t.smallest(len(u)) < 2 << band and t.largest(len(u)) >= 1 << band for band in bands)
            return elements(u, t).view(np.int64) if near else np.zeros(0, np.int64), False

        def flush():
            nonlocal count
            sig, name = (np.concatenate(x) for x in zip(*held))
            held.clear()
            count = 0
            yield {"sig": sig, "name": name, "rep": _spread(sig, name)}

        def each(batch):
            nonlocal count
            if batch is None:
                if lost:
                    own = np.array(sorted(lost), np.int64)
                    held.append((np.full(len(own), _RAN_OUT), own))
                if held:
                    yield from flush()
                return
            for rows in rows_of(batch):
                if len(seen) > 1 << 20:
                    seen.clear()
                for u in sets_of(utf8(rows["text"]), words, width):
                    if not len(u) or (own := names.of(u)) in seen:
                        continue
                    seen.add(own)
                    found, out = of(u)
                    held.append((found, np.full(len(found), own, np.int64)))
                    count += len(found)
                    if out:
                        lost.add(len(u).bit_length() - 1)
                if count > ROWS:
                    yield from flush()

        return each

    return batched(source, "sig bigint, name bigint, rep bigint", make, ends=True)


def _spread(sig: np.ndarray, name: np.ndarray) -> pa.Array:
    """For each row beyond the first ``FEW`` and one more of its signature, the first one's name; else null."""
    order = np.lexsort((name, sig))
    own, of = sig[order], name[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(own))))
    far = (np.arange(len(own)) - first[group] > FEW) & (own != _RAN_OUT)
    rep, is_far = np.empty(len(own), np.int64), np.empty(len(own), bool)
    rep[order], is_far[order] = of[first[group]], far
    return pa.array(rep, mask=~is_far)


def _candidates(signed: DataFrame) -> DataFrame:
    """From signatures to ``a, b, shared`` (pairs and how many signatures at hand they share) and,
    with ``sig``, the members of large groups. Bands that ran out have b = -1 and sig = -1."""

    def make():
        held, count, stream = [], 0, _Groups()

        def flush(ends: bool):
            nonlocal count
            t = pa.concat_tables(held).combine_chunks() if held else None
            held.clear()
            count = 0
            if t is not None:
                dealt = t["rep"].is_valid().to_numpy(zero_copy_only=False)
                sig, name = t["sig"].to_numpy(), t["name"].to_numpy()
                spread = t.filter(pa.array(dealt))
                yield _rows(spread["rep"].to_numpy(), spread["name"].to_numpy(), spread["sig"].to_numpy(), spread["name"].to_numpy())
                yield stream.add(sig[~dealt], name[~dealt])
            if ends:
                yield stream.add(*(np.zeros(0, np.int64),) * 2, True)

        def each(batch):
            nonlocal count
            if batch is not None:
                held.append(pa.Table.from_batches([batch]))
                count += batch.num_rows
            if batch is None or count > ROWS:
                yield from flush(batch is None)

        return each

    key = F.when(F.col("rep").isNull(), F.col("sig")).otherwise(F.xxhash64("name"))
    dealt = signed.repartition(key).sortWithinPartitions("sig", "name")
    return batched(dealt, "a bigint, b bigint, shared bigint, sig bigint", make, ends=True)


class _Groups:
    """Groups of one signature out of a stream that is sorted by signature and name. Of the last
    group, which may go on, at most a few rows are held."""

    def __init__(self):
        self.sig, self.name = (np.zeros(0, np.int64),) * 2
        self.large: tuple[int, int, int] | None = None  # signature, first and last name of a large group that goes on

    def add(self, sig: np.ndarray, name: np.ndarray, ends: bool = False) -> dict:
        sig, name = np.concatenate([self.sig, sig]), np.concatenate([self.name, name])
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])])[: len(sig)]
        sig, name = sig[new], name[new]
        more = name[:0]
        if self.large and len(sig):
            own, rep, last = self.large
            upto = int(np.searchsorted(sig, own, "right"))
            more = name[:upto][name[:upto] != last]
            group = own, rep, int(more[-1]) if len(more) else last
            more_sig = np.full(len(more), own)
            self.large = group if upto == len(sig) else None
            sig, name = sig[upto:], name[upto:]
            reps = np.full(len(more), rep)
        else:
            reps = more_sig = more
        self.sig, self.name = sig[:0], name[:0]
        if len(sig) and not ends:
            cut = int(np.searchsorted(sig, sig[-1], "left"))
            if len(sig) - cut > FEW and sig[-1] != _RAN_OUT:
                self.large = int(sig[-1]), int(name[cut]), int(name[-1])
            else:
                self.sig, self.name, sig, name = sig[cut:], name[cut:], sig[:cut], name[:cut]
        a, b, members, of, lost = _pairs(sig, name)
        return _rows(np.concatenate([a, reps]), np.concatenate([b, more]), np.concatenate([of, more_sig]), np.concatenate([members, more]), lost)


def _rows(a: np.ndarray, b: np.ndarray, sig: np.ndarray, members: np.ndarray, lost: np.ndarray | None = None) -> dict:
    lost = a[:0] if lost is None else lost
    pairs, shared = np.unique(np.stack([a, b]), axis=1, return_counts=True) if len(a) else (np.zeros((2, 0), np.int64), a)
    none = lambda n: [None] * n
    return {
        "a": [*pairs[0].tolist(), *members.tolist(), *lost.tolist()],
        "b": [*pairs[1].tolist(), *none(len(members)), *([-1] * len(lost))],
        "shared": [*shared.tolist(), *none(len(members)), *none(len(lost))],
        "sig": [*none(len(shared)), *sig.tolist(), *([-1] * len(lost))],
    }


def _pairs(sig: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs (a, b) of whole groups, all of small ones and those with the first of large ones; the
    members of large groups and their signatures; the bands that ran out."""
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))[: len(sig)]
    size = np.diff(np.append(first, len(sig)))
    lost = name[sig == _RAN_OUT]
    use = (size > 1) & (sig[first] != _RAN_OUT)
    first, size = first[use], size[use]
    a, b = [], []
    for g in range(2, FEW + 1):  # all pairs of small groups, groups of one size at a time
        at = first[size == g]
        for i in range(g if len(at) else 0):
            for j in range(i + 1, g):
                a.append(name[at + i])
                b.append(name[at + j])
    large = size > FEW
    reps = np.repeat(first[large], size[large])
    members = np.concatenate([np.arange(f, f + s) for f, s in zip(first[large], size[large])] or [first[:0]])
    star = members != reps
    a.append(name[reps[star]])
    b.append(name[members[star]])
    return np.concatenate(a), np.concatenate(b), name[members], sig[members], lost


def _payload(df: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, kind: str, by: Names) -> DataFrame:
    """``name, payload`` for the nodes wanted (doc, name): their elements or their bitmaps."""
    source = id_and_text(df, id_col, text_col).join(nodes.withColumnRenamed("doc", "node_doc"), F.col("doc") == F.col("node_doc"))

    def make():
        words = Words()

        def each(batch):
            for rows in rows_of(batch):
                own = sets_of(utf8(rows["text"]), words, width)
                names = rows["name"].to_pylist()
                right = [k for k, u in enumerate(own) if len(u) and by.of(u) == names[k]]
                pack = bitmap if kind == "bitmap" else np.ndarray.tobytes
                yield {"name": [names[k] for k in right], "n": [len(own[k]) for k in right], "payload": [pack(own[k]) for k in right]}

        return each

    found = batched(source.select("text", "name"), "name bigint, n bigint, payload binary", make)
    return found.dropDuplicates(["name"])


def _verified(
    pairs: DataFrame, df: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, t: Threshold, by: Names
) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("name")).union(pairs.select(F.col("b").alias("name"))).distinct()
    own, _ = materialize(_payload(df, nodes.join(wanted, "name"), id_col, text_col, width, "set", by), "sets")
    left = own.select(F.col("name").alias("a"), F.col("payload").alias("x"))
    right = own.select(F.col("name").alias("b"), F.col("payload").alias("y"))

    def make():
        def each(batch):
            for rows in rows_of(batch):
                keep = []
                for k, (x, y) in enumerate(zip(rows["x"], rows["y"])):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(x) + len(y)
                    same = both - len(np.unique(np.concatenate([x, y])))
                    if same * t.den >= t.num * (both - same):
                        keep.append(k)
                keep = np.array(keep, np.int64)
                yield {"a": rows["a"].to_numpy()[keep], "b": rows["b"].to_numpy()[keep]}

        return each

    return batched(pairs.select("a", "b").join(left, "a").join(right, "b"), "a bigint, b bigint", make)


def _from_large(groups: DataFrame, maps: DataFrame, t: Threshold, nearest: bool) -> DataFrame:
    """Pairs (a, b) of different components out of large mixed groups (sig, name, root, blocks) that the
    bitmaps don't rule out; with ``nearest``, for each set of a block only the pair that they
    hold to be the closest. A group is cut into blocks; each pair of blocks is a unit of work."""
    own = groups
    if not nearest:
        # a pair that shares several large groups becomes a row in the first of them only, as
        # far as both sets are in few enough to name them all
        listed = groups.groupBy("name").agg(F.count("*").alias("_in"), F.sort_array(F.collect_list("sig")).alias("_sigs"))
        listed = listed.select("name", F.when(F.col("_in") <= NAMED, F.col("_sigs")).alias("sigs"))
        maps = maps.join(listed, "name")
    else:
        maps = maps.withColumn("sigs", F.lit(None).cast("array<bigint>"))
    own = own.join(maps, "name")
    block = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    own = own.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = own.select(
        "sig",
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        (F.col("block") > F.col("other")).alias("second"),
        "name",
        "n",
        "root",
        F.col("payload").alias("map"),
        "sigs",
    )

    def compare(group):
        sig, one = group["sig"][0].as_py(), group["lo"][0] == group["hi"][0]
        names = group["name"].to_numpy()
        second = group["second"].to_numpy(zero_copy_only=False)
        maps = group["map"].to_pylist()
        i, j, apart = _close(maps, group["n"].to_numpy(), group["root"].to_numpy(), second, one, t)
        if nearest:
            both = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([apart, apart])
            order = np.lexsort((both[1], both[2], both[0]))
            _, first = np.unique(both[0][order], return_index=True)
            i, j = both[0][order][first], both[1][order][first]
        elif len(i):
            sigs = group["sigs"].to_pylist()
            keep = [_first_common(sigs[x], sigs[y], sig) for x, y in zip(i, j)]
            i, j = i[keep], j[keep]
        pairs = np.sort(np.stack([names[i], names[j]], 1), axis=1)
        return {"a": pairs[:, 0], "b": pairs[:, 1]}

    return by_group(unit, ["sig", "lo", "hi"], "a bigint, b bigint", compare).distinct()


def _first_common(x, y, sig: int) -> bool:
    return x is None or y is None or sig == min(set(x).intersection(y), default=sig)


def _close(maps, n: np.ndarray, root: np.ndarray, second: np.ndarray, one: bool, t: Threshold):
    """Row numbers of pairs of different components that the bitmaps don't rule out, and the bits
    in which they differ. A part of the bits goes first, which rules out most."""
    words = min(len(m) for m in maps) // 8
    full = np.stack([_fold(m, words) for m in maps])
    part = max(words // 8, min(words, 4))
    coarse = np.bitwise_xor.reduce(full.reshape(len(n), -1, part), axis=1)
    rows, cols = (np.arange(len(n)),) * 2 if one else (np.flatnonzero(~second), np.flatnonzero(second))
    step = max(1, (1 << 19) // max(len(cols) * part, 1))
    found = []
    for at in range(0, len(rows), step):
        own = rows[at : at + step]
        apart = np.zeros((len(own), len(cols)), np.int64)
        for w in range(part):
            apart += np.bitwise_count(coarse[own, w][:, None] ^ coarse[cols, w])
        x, y = n[own][:, None], n[cols]
        ok = (apart * (t.den + t.num) <= (x + y) * (t.den - t.num)) & (root[own][:, None] != root[cols])
        ok &= (y * t.den >= x * t.num) & (x * t.den >= y * t.num)
        if one:
            ok &= cols > own[:, None]
        i, j = np.nonzero(ok)
        i, j = own[i], cols[j]
        for k in range(0, len(i), 1 << 14):
            a, b = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
            bits = np.bitwise_count(full[a] ^ full[b]).sum(1, dtype=np.int64)
            near = bits * (t.den + t.num) <= (n[a] + n[b]) * (t.den - t.num)
            found.append((a[near], b[near], bits[near]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WORDS,
    similarity: tuple[int, int] = (4, 5),
) -> DataFrame:
    """``doc, n_shingles, component`` of every row with an id.

    Rows are linked when the Jaccard similarity of their sets of ``width``-word shingles is
    ``similarity`` (a fraction) or more; ``component`` is the smallest id that links reach.
    Elements are 64-bit hashes, sets are told apart by 128 bits. A null or blank text has an empty set and no links. Rows with
    equal ids are one document of several texts. Rows with a null id are left out, as they can
    be neither named nor linked: give ``key_of`` as the id where there are some. Other columns
    are not read.
    """
    t = Threshold(*similarity)
    df = df.filter(F.col(f"`{id_col}`").isNotNull())
    docs, names = named_sets(df, id_col, text_col, width)
    named = docs.filter(F.col("name").isNotNull())
    nodes = named.groupBy("name").agg(F.min("doc").alias("doc"))

    found, told = materialize(
        _candidates(_emit(df, text_col, width, t, names)), "candidates", F.count_if(F.col("sig") == -1).alias("lost")
    )
    if told["lost"]:
        bands = [r["a"] for r in found.filter("sig = -1").select("a").distinct().collect()]  # of powers of two
        more, _ = materialize(_candidates(_emit(df, text_col, width, t, names, bands)), "candidates")
        found = found.filter("sig is null or sig <> -1").union(more)
    pairs = found.filter("sig is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    pairs, _ = materialize(pairs, "pairs")

    def linked(wanted: DataFrame, before: DataFrame | None, name: str) -> DataFrame:
        """Components after the wanted pairs are verified, too."""
        links = _verified(wanted, df, nodes, id_col, text_col, width, t, names)
        if before is not None:
            tree = before.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
            links = links.union(tree)
        return materialize(components(links), name)[0]

    def root_of(frame: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
        known = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
        return frame.join(known, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")

    def mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
        """The groups (sig, name) that hold different components, with these and the number of
        blocks; written, as they are used again."""
        own = root_of(members, roots, "name", "root")
        blocks = F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
        seen = own.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), blocks)
        return materialize(own.join(seen.filter("lo <> hi").select("sig", "blocks"), "sig"), "mixed-groups")[0]

    # 1. the pair with most shared signatures of each set: a forest that joins most copies
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", "b")
    roots = linked(best, None, "roots")
    # 2. of sets in large groups that are in different components still, the closest by their bitmaps
    groups = mixed(found.filter("sig is not null").select("sig", F.col("a").alias("name")), roots)
    wanted = groups.select("name").distinct()
    maps, _ = materialize(_payload(df, nodes.join(wanted, "name"), id_col, text_col, width, "bitmap", names), "bitmaps")
    close, _ = materialize(_from_large(groups, maps, t, True), "closest")
    tried = best.union(close)
    roots = linked(close, roots, "roots")
    groups = mixed(groups.select("sig", "name"), roots)
    # 3. every pair that may still join different components
    rest = root_of(root_of(pairs, roots, "a", "ra"), roots, "b", "rb").filter("ra <> rb").select("a", "b")
    rest = rest.union(_from_large(groups, maps, t, False)).distinct().join(tried, ["a", "b"], "left_anti")
    rest, _ = materialize(rest, "rest")
    joined = linked(rest, roots, "roots")

    least = _least_ids(named, joined)
    return docs.join(least, ["doc", "name"], "left").select(
        "doc", F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component")
    )


def _least_ids(named: DataFrame, joined: DataFrame) -> DataFrame:
    """``doc, name, component`` of every row with words."""
    own = named.join(joined.withColumnRenamed("node", "name"), "name", "left")
    own = own.withColumn("root", F.coalesce("root", "name")).select("doc", "name", "root").distinct()
    several = own.groupBy("doc").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    twice = own.join(several.select("doc"), "doc").join(several, "doc").filter("root <> lo")
    again = components(twice.select(F.col("lo").alias("a"), F.col("root").alias("b")))
    again = again.select(F.col("node").alias("root"), F.col("root").alias("top"))
    own = own.join(again, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    least = own.groupBy("root").agg(F.min("doc").alias("component"))
    return own.join(least, "root").select("doc", "name", "component")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, own = table(spark, sf_dir, "documents"), ""
    if any_without_id(docs):
        docs, own = docs.select(key_of().alias("doc_id"), "text"), ".id"
    found = near_duplicates(docs)
    return found.select(F.col(f"doc{own}").alias("doc_id"), "n_shingles", F.col(f"component{own}").alias("component_id"))

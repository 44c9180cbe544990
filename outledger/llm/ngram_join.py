"""N-gram Jaccard self-join with size-banded tiles and hashed bitmap signatures.

A document is the set of its distinct five-word shingles (hashed to 64 bits). Equal sets are one
set, named by a hash over their shingles. Two sets link when 100 |x & y| >= percent |x | y|.

Candidates are exact: with all shingles in one global order, two linked sets share a shingle among
the first |x| - ceil(percent |x| / 100) + 1 of each. The order puts frequent shingles last (the
``hot`` most frequent by counts of the whole corpus, a bounded table; order only decides speed), so
a passage that many documents share is not in their prefixes. Sets that share a prefix shingle form
a tile group, in which the join runs twice:

1. Stars: each group's smallest set against the others. Verified links give first components.
2. Tiles: groups that still hold several components are cut by size band (a band spans a factor of
   100 / percent, so only equal and adjacent bands can link) and into blocks of ``block`` sets; each
   pair of blocks is a tile. Pairs within one component are never formed, so a large group of near
   copies costs its number of members, not its square.

Tiles run in ``FORESTS`` rounds that emit forests: a task joins the components of the pairs it lets
through and emits only pairs that join two of its trees, at most one row a component. After each round
the pairs are verified and the components contracted, and groups that let no pair through are done
(contraction only takes pairs away). What is left, sets just below the limit for the most part, goes
through a last round in which tiles carry the shingles too: every pair of two components that the
signatures let through is verified inside its tile, and only links that join two trees are emitted. So
no round makes more rows than a task has sets, and no link is lost.

In all, a pair counts only if the sizes and the positions of the shared shingle leave room for the
overlap it needs (at its first common shingle a linked pair always has that room), and goes on only
if the signatures allow it.

A signature is a parity bitmap: every shingle flips the bit its hash names. Bits that differ bound
the symmetric difference from below, hence the overlap from above: overlap <= (|x| + |y| - bits)/2.
Pairs that pass are verified by intersecting the sorted shingle arrays.

Bitmaps grow with the set (at least ``BITS`` bits a shingle, a power of two) and fold to a common
size. With so many bits few flips cancel, so sets just below the limit are told from linked ones.

Nulls and texts without words have an empty set, link with nothing and are their own component (a
null id gives a null component). Repeated rows are equal sets. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import BLANKS, arrow_schema, encoded, filtered, text_key, texts
from outledger.llm.components import components
from outledger.session import pin

WIDTH = 5
PERCENT = 75
#: Frequent shingles that are ordered last, the count within a part of a task from which one is
#: noted, and the number of hashes of such a part.
HOT = 262_144
HOT_IN_CHUNK = 3
CHUNK_BYTES = 4 << 20
NOTED_HASHES = 4_000_000
#: Bits of a signature for each shingle of its set, at least.
BITS = 4
#: Rounds that emit forests, sets of a task's memory of what it has joined, bytes of shingles in a tile,
#: rows of groups that a task handles at a time, and rows from which one group is handled in parts.
FORESTS = 2
REMEMBERED = 1_000_000
TILE_BYTES = 16 << 20
GROUP_ROWS = 200_000
LARGE_GROUP = 1_000_000

U64 = np.uint64
BYTE_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
BASE, WORD_BASE = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True

SETS = "kind int, doc_id long, text_key long, set_id long, size int, signature binary, n long"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and for each text the index of its first word (n + 1)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = IS_BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(starts, np.concatenate(([0], ends)))
    if not len(starts):
        return np.zeros(0, U64), first
    place = np.arange(len(data)) - np.repeat(
        np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)])))
    )
    values = BYTE_VALUES[data] * powers(BASE, int(place.max()) + 1)[place]
    values[blank] = 0
    return mix(np.add.reduceat(values, starts)), first


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each lower-cased text."""
    words, first = word_hashes(texts)
    weights = powers(WORD_BASE, width + 1)
    n = len(words) - width + 1
    if n > 0:
        total = np.repeat(np.array([width], U64) * weights[width], n)
        for k in range(width):
            total += words[k : k + n] * weights[k]
        total = mix(total)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(total[a : b - width + 1])
        elif b > a:
            whole = (words[a:b] * weights[: b - a]).sum(keepdims=True)
            yield mix(whole + np.array([b - a], U64) * weights[width])
        else:
            yield np.zeros(0, U64)


def set_name(hashes: np.ndarray) -> int:
    """64-bit name of a set, as a signed long."""
    whole = mix(hashes ^ BASE).sum(keepdims=True) + np.array([len(hashes)], U64) * WORD_BASE
    return int(mix(whole).view(np.int64)[0])


def signature(hashes: np.ndarray) -> bytes:
    """Parity bitmap of ``BITS`` bits a shingle, rounded up to a power of two."""
    bits = max(64, 1 << (BITS * len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(bitmap: bytes, n_bytes: int) -> np.ndarray:
    """The bitmap at a smaller size: halves laid over each other by exclusive or."""
    x = np.frombuffer(bitmap, np.uint8)
    while len(x) > n_bytes:
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return x


def needed(size: int, percent: int) -> int:
    """Least overlap with any linked set: ceil(percent size / 100)."""
    return -(-percent * size // 100)


def may_link(sizes, other_sizes, differing, percent: int):
    """Whether the bound on the overlap allows a link; works on arrays."""
    both = sizes + other_sizes
    return (both - differing) * (100 + percent) >= 2 * percent * both


def chunks(batches: Iterator[pa.RecordBatch], n_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and lower-cased texts of a few megabytes at a time, whatever the batches."""
    ids, found, held = [], [], 0
    for batch in batches:
        first = batch.column(0).to_pylist()
        for doc, text in zip(first, batch.column(1), strict=True):
            ids.append(tuple(doc.values()) if isinstance(doc, dict) else doc)
            found.append(encoded(text.as_py()).translate(LOWER))
            held += len(found[-1])
            if held >= n_bytes:
                yield ids, found
                ids, found, held = [], [], 0
    if ids:
        yield ids, found


def document_sets(docs: DataFrame) -> DataFrame:
    """``SETS``: a row of kind 0 per document, rows of kind 1 for shingles that several
    sets of a part of a task share."""
    schema = arrow_schema(docs.sparkSession, SETS)

    def run(batches):
        everything: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        for ids, found in chunks(batches, CHUNK_BYTES):
            rows = []
            for (doc, key), hashes in zip(ids, shingle_sets(found), strict=True):
                if len(hashes):
                    name = set_name(hashes)
                    rows.append((0, doc, key, name, len(hashes), signature(hashes), None))
                    if name not in seen:
                        seen.add(name)
                        everything.append(hashes)
                        held += len(hashes)
                else:
                    rows.append((0, doc, key, None, 0, None, None))
            if held >= NOTED_HASHES:
                rows += noted(everything)
                everything, held = [], 0
            yield batch_of(rows)
        if everything and (rows := noted(everything)):
            yield batch_of(rows)

    def noted(everything: list[np.ndarray]) -> list[tuple]:
        keys, n = np.unique(np.concatenate(everything), return_counts=True)
        often = n >= HOT_IN_CHUNK
        pairs = zip(keys[often].view(np.int64).tolist(), n[often].tolist(), strict=True)
        return [(1, None, None, key, None, None, count) for key, count in pairs]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    keyed = docs.select(F.struct("doc_id", text_key().alias("text_key")).alias("id"), "text")
    return keyed.mapInArrow(run, SETS)


def frequent(noted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The at most ``most`` most frequent shingles, sorted, and their counts."""
    rows = (
        noted.groupBy("set_id").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "set_id").limit(most).collect()
    )
    keys = np.array([r["set_id"] for r in rows], np.int64).view(U64)
    order = np.argsort(keys)
    return keys[order], np.array([r["n"] for r in rows], np.int64)[order]


def prefix(hashes: np.ndarray, hot: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The prefix of a set in the global order: by noted frequency, then by hash."""
    length = len(hashes) - needed(len(hashes), percent) + 1
    keys, counts = hot
    if not len(keys):
        return hashes[:length]
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    weight = np.where(keys[at] == hashes, counts[at], 0)
    if not weight.any():
        return hashes[:length]
    return hashes[np.argsort(weight, kind="stable")[:length]]


PREFIXES = "key long, set_id long, size int, pos int"
GROUPS = "group_id long, a long, b long, size int, pos int, n int"


def prefix_rows(docs: DataFrame, hot, percent: int) -> DataFrame:
    """``PREFIXES``: the prefix shingles of every set by position; a task emits a set once."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        seen: set[int] = set()
        for _, found in chunks(batches, CHUNK_BYTES):
            keys, names, sizes = [], [], []
            for hashes in shingle_sets(found):
                if len(hashes) and (name := set_name(hashes)) not in seen:
                    seen.add(name)
                    keys.append(prefix(hashes, shared.value, percent))
                    names.append(name)
                    sizes.append(len(hashes))
            if keys:
                n = np.array([len(k) for k in keys])
                pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                columns = [
                    np.concatenate(keys).view(np.int64), np.repeat(np.array(names, np.int64), n),
                    np.repeat(np.array(sizes, np.int32), n), pos.astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["key", "set_id", "size", "pos"]
                )

    return docs.mapInArrow(run, PREFIXES)


def may_share(size, pos, other_size, other_pos, percent: int):
    """Whether two sets whose first common shingle stands at these positions can link."""
    both = size + other_size
    least = -(-percent * both // (100 + percent))
    small, large = np.minimum(size, other_size), np.maximum(size, other_size)
    rest = np.minimum(size - pos, other_size - other_pos)
    return (100 * small >= percent * large) & (rest >= least)


def group_rows(rows: DataFrame, parts: int, percent: int) -> DataFrame:
    """``GROUPS`` of two kinds from the prefix shingles that several sets share.

    Stars (n = 0): the group's smallest set and another one, where sizes and positions allow a link.
    Members (n > 2): set ``a`` of a group of n sets, with its position. Groups that a task handles at a
    time and that have the same members are one group, at the first of their shingles in the global
    order. Rows come sorted by shingle and set; a group above ``LARGE_GROUP`` rows is handled in parts
    (its n is that bound).
    """
    names = ["group_id", "a", "b", "size", "pos", "n"]
    kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)

    def batch(*columns) -> pa.RecordBatch:
        arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def stars(first, second) -> pa.RecordBatch:
        pairs = np.unique(np.stack((first, second), axis=1), axis=0)
        none = np.zeros(len(pairs), np.int32)
        return batch(none, pairs[:, 0], pairs[:, 1], none, none, none)

    def whole(keys, sets, size, pos):
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])))
        keys, sets, size, pos = keys[fresh], sets[fresh], size[fresh], pos[fresh]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n = np.diff(np.concatenate((starts, [len(keys)])))
        named = np.add.reduceat(mix(sets.view(U64) ^ BASE), starts) + n.astype(U64)
        order = np.lexsort((pos[starts], named))
        order = order[n[order] > 1]
        if not len(order):
            return
        once = np.concatenate(([True], named[order][1:] != named[order][:-1]))
        chosen = order[once]
        n, begin, named = n[chosen], starts[chosen], named[chosen].view(np.int64)
        at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(begin, n)
        star = (at != first) & may_share(size[first], pos[first], size[at], pos[at], percent)
        yield stars(sets[first][star], sets[at][star])
        large = np.repeat(n, n) > 2
        of, at = np.repeat(named, n)[large], at[large]
        yield batch(of, sets[at], sets[at], size[at], pos[at], np.repeat(n, n)[large])

    def part(first, keys, sets, size, pos):
        star = (sets != first[1]) & may_share(first[2], first[3], size, pos, percent)
        yield stars(np.repeat(first[1], star.sum()), sets[star])
        yield batch(keys, sets, sets, size, pos, np.full(len(keys), LARGE_GROUP))

    def run(batches):
        held: list[list[np.ndarray]] = []
        n, first = 0, None  # first: row of the smallest set of a group that is handled in parts
        for got in batches:
            if not got.num_rows:
                continue
            held.append([c.to_numpy() for c in got.columns])
            n += got.num_rows
            if n < GROUP_ROWS:
                continue
            rows_ = [np.concatenate(x) for x in zip(*held, strict=True)]
            if first is not None:
                cut = int(np.searchsorted(rows_[0], first[0], side="right"))
                if cut:
                    yield from part(first, *(c[:cut] for c in rows_))
                rows_ = [c[cut:] for c in rows_]
                first = first if not len(rows_[0]) else None
            if len(rows_[0]):
                cut = int(np.searchsorted(rows_[0], rows_[0][-1]))
                if cut:
                    yield from whole(*(c[:cut] for c in rows_))
                rows_ = [c[cut:] for c in rows_]
                if len(rows_[0]) >= LARGE_GROUP:
                    first = [int(c[0]) for c in rows_]
                    yield from part(first, *rows_)
                    rows_ = [c[:0] for c in rows_]
            held, n = [rows_], len(rows_[0])
        rows_ = [np.concatenate(x) for x in zip(*held, strict=True)] if held else []
        if rows_ and first is not None and len(rows_[0]):
            cut = int(np.searchsorted(rows_[0], first[0], side="right"))
            if cut:
                yield from part(first, *(c[:cut] for c in rows_))
            rows_ = [c[cut:] for c in rows_]
        if rows_ and len(rows_[0]):
            yield from whole(*rows_)

    dealt = rows.repartition(parts, "key").sortWithinPartitions("key", "set_id")
    return dealt.mapInArrow(run, GROUPS)


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures allow a link."""
    schema = arrow_schema(pairs.sparkSession, "a long, b long")

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("set_id").alias(name), F.col("size").alias(f"size_{name}"),
            F.col("signature").alias(f"bits_{name}"),
        )

    def run(batches):
        for batch in batches:
            rows, kept = batch.to_pydict(), []
            for a, b, x, y, p, q in zip(*(rows[c] for c in columns), strict=True):
                if min(x, y) < needed(max(x, y), percent):
                    continue
                n = min(len(p), len(q))
                bits = int(np.bitwise_count(fold(p, n) ^ fold(q, n)).sum())
                if may_link(x, y, bits, percent):
                    kept.append((a, b))
            a, b = zip(*kept, strict=True) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    columns = ["a", "b", "size_a", "size_b", "bits_a", "bits_b"]
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select(*columns)
    return joined.mapInArrow(run, "a long, b long")


def shingle_arrays(wanted: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``set_id, hashes``: the sorted shingles of the wanted sets, built again from their texts."""
    where = wanted.join(sets, "set_id").select("set_id", F.col("first_doc").alias("of_doc"))
    found = docs.join(where, F.col("doc_id").eqNullSafe(F.col("of_doc"))).select("set_id", "text")

    def build(batches):
        for ids, texts_ in chunks(batches, CHUNK_BYTES):
            kept = {
                name: hashes.tobytes()
                for name, hashes in zip(ids, shingle_sets(texts_), strict=True)
                if len(hashes) and set_name(hashes) == name  # ids may repeat with other texts
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.int64()), pa.array(list(kept.values()), pa.binary())],
                names=["set_id", "hashes"],
            )

    return found.mapInArrow(build, "set_id long, hashes binary")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: both sets are built again from texts and intersected."""
    pairs = pin(pairs)
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    arrays = pin(shingle_arrays(wanted, sets, docs))

    def run(batches):
        for batch in batches:
            kept = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if linked(np.frombuffer(x, U64), np.frombuffer(y, U64), percent):
                    kept.append((a, b))
            a, b = zip(*kept, strict=True) if kept else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    left = pairs.join(arrays.select(F.col("set_id").alias("a"), F.col("hashes").alias("x")), "a")
    both = left.join(arrays.select(F.col("set_id").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def tiles(live: DataFrame, percent: int, block: int) -> DataFrame:
    """Members of live groups dealt to tiles: ``tile`` and ``side`` beside the member's columns.

    A group of at most ``block`` sets and ``TILE_BYTES`` of shingles is one tile. A larger one is cut by
    size band and then into blocks below these bounds; every pair of blocks of one band (side 0) or of neighbouring bands (sides 1 and 2) is a
    tile, and a member is repeated once per tile of its block.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    fits = (F.col("n") <= block) & (8 * F.col("total") <= TILE_BYTES)
    small = live.where(fits).select("*", F.xxhash64("group_id").alias("tile"), F.lit(0).alias("side"))
    banded = live.where(~fits).withColumn("band", band.cast("int"))
    k = F.ceil(F.greatest(F.count("*") / block, 8 * F.sum("size") / TILE_BYTES)).cast("int")
    counts = pin(banded.groupBy("group_id", "band").agg(k.alias("k")))
    own = banded.join(counts, ["group_id", "band"])
    own = own.withColumn("at", F.pmod(F.xxhash64("set_id"), F.col("k")).cast("int"))
    for name, step in (("above", 1), ("below", -1)):
        near = counts.select("group_id", (F.col("band") - step).alias("band"), F.col("k").alias(name))
        own = own.join(near, ["group_id", "band"], "left")

    def tile(low, kind: int, i, j, side: int):
        key = F.xxhash64("group_id", low, F.lit(kind), i.cast("int"), j.cast("int"))
        return F.struct(key.alias("tile"), F.lit(side).alias("side"))

    def others(k, make):
        return F.when(k > 0, F.transform(F.sequence(F.lit(0), k - 1), make)).otherwise(F.array())

    at, here = F.col("at"), F.col("band")
    same = others(F.col("k"), lambda j: tile(here, 0, F.least(at, j), F.greatest(at, j), 0))
    up = others(F.coalesce("above", F.lit(0)), lambda j: tile(here, 1, at, j, 1))
    down = others(F.coalesce("below", F.lit(0)), lambda i: tile(here - 1, 1, i, at, 2))
    spread = own.select(*live.columns, F.explode(F.concat(same, up, down)).alias("t"))
    return small.unionByName(spread.select(*live.columns, "t.tile", "t.side"))


class Trees:
    """The components that the pairs of a task have joined so far; forgets all when it gets too large."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (y := self.up.get(top, top)) != top:
            top = y
        while x != top:
            x, self.up[x] = self.up.get(x, x), top
        return top

    def join(self, x: int, y: int) -> None:
        if len(self.up) > REMEMBERED:
            self.up.clear()
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def tile_pairs(live: DataFrame, percent: int, block: int, parts: int) -> DataFrame:
    """Pairs of different components whose sizes, positions and signatures allow a link, as a forest.

    ``live`` holds ``group_id, set_id, component, size, pos, n, total, signature``. With a column
    ``hashes`` the pairs are verified, and the forest is one of links. A task holds one tile at a time.
    Returns ``group_id, a, b``: the pairs, and a row with null ``a, b`` for every tile that lets one
    through.
    """
    exact = "hashes" in live.columns
    names = ["tile", "side", "set_id", "component", "size", "pos", "group_id", "signature"]
    names += ["hashes"] if exact else []
    dealt = tiles(live, percent, block).select(*names)

    def pairs_of(columns: list[np.ndarray], trees: Trees) -> tuple[list[tuple[int, int]], bool]:
        order = np.argsort(columns[3], kind="stable")
        side, name, comp, size, pos, _, maps, *more = (x[order] for x in columns)
        hashes = [np.frombuffer(h, U64) for h in more[0]] if exact else []
        ends = np.searchsorted(size, size * 100 // percent, side="right")
        lengths = np.array([len(m) for m in maps])
        row = np.zeros(len(maps), np.int64)  # of a set's bitmap among those of its length
        full, half = {}, {}
        for n in np.unique(lengths).tolist():
            of = np.flatnonzero(lengths == n)
            row[of] = np.arange(len(of))
            full[n] = np.frombuffer(b"".join(maps[of]), np.uint8).reshape(len(of), n).view(U64)
            wide = full[n].shape[1] // 2
            half[n] = full[n][:, :wide] ^ full[n][:, wide:]
        out, some = [], False
        for i in range(len(name)):
            j = slice(i + 1, ends[i])
            ok = (comp[j] != comp[i]) & ((side[j] != side[i]) | (side[i] == 0))
            ok &= may_share(size[i], pos[i], size[j], pos[j], percent)
            js = np.flatnonzero(ok) + i + 1
            n = int(lengths[i])
            # A linked partner is at most 100 / percent larger: its bitmap is as long or twice as.
            for length, side_maps in ((n, full), (2 * n, half)):
                near = js[lengths[js] == length]
                if not len(near):
                    continue
                bits = side_maps[length][row[near]] ^ full[n][row[i]]
                differing = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
                for k in near[may_link(size[i], size[near], differing, percent)].tolist():
                    some = True
                    apart = trees.root(comp[i]) != trees.root(comp[k])
                    if apart and (not exact or linked(hashes[i], hashes[k], percent)):
                        trees.join(comp[i], comp[k])
                        out.append((min(name[i], name[k]), max(name[i], name[k])))
        return out, some

    def run(batches):
        held: list[np.ndarray] | None = None  # rows of the tile that may go on in the next batch
        trees = Trees()
        for batch in batches:
            columns = []
            for at, column in enumerate(batch.columns):
                if at < 7:
                    columns.append(column.to_numpy().astype(np.int64))
                else:
                    columns.append(np.empty(batch.num_rows, object))
                    columns[-1][:] = column.to_pylist()
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            cut = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
            bounds = [0, *cut.tolist()]
            for x, y in zip(bounds, bounds[1:], strict=False):
                yield batch_of([c[x:y] for c in columns[1:]], trees)
            held = [c[bounds[-1] :] for c in columns]
        if held is not None and len(held[0]):
            yield batch_of(held[1:], trees)

    def batch_of(columns: list[np.ndarray], trees: Trees) -> pa.RecordBatch:
        found, some = pairs_of(columns, trees)
        rows = [(columns[5][0], None, None)] * some + [(None, a, b) for a, b in found]
        arrays = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ((), (), ()))]
        return pa.RecordBatch.from_arrays(arrays, names=["group_id", "a", "b"])

    sorted_ = dealt.repartition(parts, "tile").sortWithinPartitions("tile")
    return sorted_.mapInArrow(run, "group_id long, a long, b long")


def in_several_components(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of groups that are not yet one component, with ``component`` and the group's ``total`` size."""
    named = found.select(F.col("node").alias("set_id"), "component")
    placed = members.join(named, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    placed = pin(placed)
    mixed = placed.groupBy("group_id").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.sum("size").alias("total")
    )
    return placed.join(mixed.where("x <> y").select("group_id", "total"), "group_id")


def jaccard_components(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    block: int = 1024,
) -> DataFrame:
    """``doc_id, text_key, class_id, n_shingles, component_id`` per row of ``df``.

    ``component_id`` is the smallest id of the component; ``class_id`` names the component by its
    smallest set (null for empty sets).
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")  # bitmaps differ by one fold at most
    docs = texts(df, doc_id, text)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    noted = pin(document_sets(docs))
    own = noted.where("kind = 0").select("doc_id", "text_key", "set_id", "size", "signature")
    hot = frequent(noted.where("kind = 1"), HOT)
    sets = pin(
        own.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
            F.min("doc_id").alias("first_doc"), F.max("size").alias("size"),
            F.max("signature").alias("signature"),
        )
    )
    groups = pin(group_rows(prefix_rows(docs, hot, percent), parts, percent))

    stars = groups.where("n = 0").select("a", "b").distinct()
    links = pin(verified(bounded(stars, sets, percent), sets, docs, percent))
    found = pin(components(links))
    members = groups.where("n > 2").groupBy("group_id", F.col("a").alias("set_id")).agg(
        F.max("size").alias("size"), F.min("pos").alias("pos"), F.max("n").alias("n")
    )
    bits = sets.select("set_id", "signature")
    for round_ in range(FORESTS + 1):
        live = in_several_components(members, found).join(bits, "set_id")
        if round_ == FORESTS:
            live = pin(live)
            live = live.join(shingle_arrays(live.select("set_id").distinct(), sets, docs), "set_id")
        across = pin(tile_pairs(live, percent, block, parts))
        if across.isEmpty():
            break
        pairs = across.where(F.col("a").isNotNull()).select("a", "b").distinct()
        if round_ < FORESTS:
            pairs = verified(pairs, sets, docs, percent)
        links = pin(links.unionByName(pairs))
        found = pin(components(links))
        open_ = across.where(F.col("group_id").isNotNull()).select("group_id").distinct()
        members = pin(members.join(open_, "group_id"))

    smallest = (
        sets.select("set_id", "first_doc")
        .join(found.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    least = smallest.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    classes = smallest.join(least, "component").select(
        F.col("set_id").alias("of_set"), F.col("component").alias("class_id"), "component_id"
    )
    rows = own.select("doc_id", "text_key", "set_id", F.col("size").cast("long").alias("n_shingles"))
    joined = rows.join(classes, F.col("set_id") == F.col("of_set"), "left")
    alone = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_key", "class_id", "n_shingles", alone.alias("component_id"))


def one_per_component(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row of ``df``, all columns, per component: that of the smallest id (and text hash).

    Documents with an empty set stay. Repeated rows of one id and text are one document: the row whose
    JSON form is the smallest.
    """
    rows = pin(jaccard_components(df, doc_id, text, percent))
    key = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    linked = rows.where(F.col("class_id").isNotNull()).groupBy("class_id").agg(F.min(key).alias("k"))
    alone = rows.where(F.col("class_id").isNull()).select("doc_id", "text_key")
    keys = linked.select("k.doc_id", "k.text_key").union(alone).distinct()
    found = filtered(df, keys, "left_semi", doc_id, text)
    one = found.groupBy("doc_id", "text_key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return one.select("row.*")
